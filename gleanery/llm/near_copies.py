"""Near copies by similarity of word shingles: SimHash keys and bands of least hashes give candidates, whole sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, heavy_join, materialize, whole_text, wide
from .components import components
from .simhash import links, set_bits, shingle_hashes

#: Least hashes of a band, and bands: two sets at a similarity of 0.8 have a whole band in common but for 6 in 10,000,000 pairs.
ROWS, BANDS = 3, 20
#: Sets of one bucket that a task compares; the rest is dealt out in pairs of blocks.
BLOCK = 2000


def _multipliers(n: int) -> np.ndarray:
    """Odd 64-bit numbers from a multiplicative rule."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ x >> np.uint64(32)) | np.uint64(1)


_TIMES = _multipliers(ROWS * BANDS)


def least_hashes(own: np.ndarray) -> np.ndarray:
    """The least value of a set of hashes under each of the multipliers, which order it anew each time."""
    return np.fromiter(((own * m).min() for m in _TIMES), np.uint64, len(_TIMES))


def band_keys(own: np.ndarray) -> list[int]:
    """A 64-bit key for each band of a set; none for an empty set."""
    if not len(own):
        return []
    data = least_hashes(own).astype("<u8").tobytes()
    width = 8 * ROWS
    return [xxhash.xxh64_intdigest(data[i * width : (i + 1) * width], i) - (1 << 63) for i in range(BANDS)]


def _marks(width: int):
    """(doc_id, h, text) -> doc_id, h, fp, k (digest of the set of shingles), n (its size), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, k, n, bands = [], [], [], []
            for t in b.column(2):
                every = shingle_hashes(t.as_py(), width)
                own = np.unique(every)
                fp.append(set_bits(every))
                k.append(xxhash.xxh3_128_digest(own.tobytes()))
                n.append(len(own))
                bands.append(band_keys(own))
            cols = [b.column(0), b.column(1), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(k, pa.binary()), pa.array(n, pa.int32()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "h", "fp", "k", "n", "bands"])

    return run


def _sets(width: int):
    """(k, text) -> k, own (the sorted hashes of the text's shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                own = [np.unique(shingle_hashes(t.as_py(), width)).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.int64()))], names=["k", "own"])

    return run


def _across(similarity: float):
    """Rows (key, k, root, own) sorted by key -> links (a, b) that join the roots of a bucket, as few as that takes."""

    def solve(rows: list[tuple[bytes, bytes, np.ndarray]]) -> list[tuple[bytes, bytes]]:
        parent: dict[bytes, bytes] = {r: r for _, r, _ in rows}

        def find(x: bytes) -> bytes:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        size = np.array([len(own) for _, _, own in rows])
        order = np.argsort(size, kind="stable")
        rows, size = [rows[i] for i in order], size[order]
        marks = np.stack([least_hashes(own) for _, _, own in rows])
        out = []
        for i, (a, ra, own) in enumerate(rows):
            lo = int(np.searchsorted(size, similarity * size[i] - 1e-9))
            # of pairs at 0.8 a fifth of the least hashes differ; with under two fifths in common there is no chance
            for j in (np.flatnonzero((marks[lo:i] == marks[i]).mean(1) >= similarity / 2) + lo).tolist():
                b, rb, other = rows[j]
                if find(ra) != find(rb):
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if common >= similarity * (len(own) + len(other) - common) - 1e-9:
                        out.append((a, b))
                        parent[find(ra)] = find(rb)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def flush() -> pa.RecordBatch:
            found = solve(held) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"])

        for batch in batches:
            for key, k, root, own in zip(*(batch.column(i) for i in range(4))):
                if key.as_py() != now:
                    if held:
                        yield flush()
                    held, now = [], key.as_py()
                held.append((k.as_py(), root.as_py(), own.values.to_numpy(zero_copy_only=False).view(np.uint64)))
        if held:
            yield flush()

    return run


def _roots(links_: DataFrame, k: Column) -> tuple[DataFrame, Column]:
    roots = components(links_).withColumnsRenamed({"node": "_node", "root": "_root"})
    return roots, F.coalesce("_root", k)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, most: int = 4, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, h (hash of the text), grp; rows of one group are connected by links between similar texts.

    Two texts are similar if their sets of ``width``-word shingles have a Jaccard similarity of ``similarity`` (0.8 or more) at least; texts
    with equal sets are one class. Candidates are the pairs of SimHash fingerprints at ``most`` or fewer differing bits, by their
    Golay keys, and classes that share a band of least hashes; each is verified on whole sets. A bucket's classes are held against one
    of them first; only buckets whose classes are then of several groups are searched pair by pair, in blocks, for links between those groups.

    Null and empty texts have no shingle and are one class. Fewer words than ``width`` are one shingle. Null ids, repeated rows and long texts
    are rows like any other; no rows give no rows; other columns are ignored.
    """
    if similarity < 0.8:
        raise ValueError("the bands hold for a similarity of 0.8 at least")
    spark = docs.sparkSession
    bounded_batches(spark)
    text = whole_text(text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    own = materialize(keyed.mapInArrow(_marks(width), f"doc_id {kind}, h long, fp long, k binary, n int, bands array<long>"), "near-marks")

    # buckets of two classes or more; copies are one class, collapsed before the exchange
    band = own.select("k", "n", F.explode("bands").alias("key")).groupBy("key", "k").agg(F.min("n").alias("n"))
    head = band.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "k").alias("o"), "k", "n")).alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    met = heavy_join(band, materialize(head.withColumn("c", F.col("m")), "near-heads"), ["key"])
    buckets = materialize(met.select("key", "k", "n", "m", F.col("head.k").alias("hk"), F.col("head.n").alias("hn")), "near-buckets")
    fits = F.least("n", "hn") >= F.greatest("n", "hn") * F.lit(similarity) - F.lit(1e-9)
    pairs = buckets.where((F.col("k") != F.col("hk")) & fits).select(F.col("hk").alias("a"), F.col("k").alias("b"))

    # fingerprints at a few bits
    prints = own.select("fp", "k").distinct()  # copies are one
    by_fp = materialize(prints.groupBy("fp").agg(F.min("k").alias("k"), F.max("k").alias("last")), "near-prints")
    close = links(by_fp.select("fp"), most)
    of = by_fp.select("fp", "k")
    pairs = pairs.unionByName(close.join(of.select(F.col("fp").alias("a"), F.col("k").alias("ka")), "a").join(of.select(F.col("fp").alias("b"), F.col("k").alias("kb")), "b").select(F.col("ka").alias("a"), F.col("kb").alias("b")))
    several = by_fp.where("k <> last").select("fp", F.col("k").alias("a"))
    pairs = pairs.unionByName(prints.select("fp", F.col("k").alias("b")).join(several, "fp").where("a <> b").select("a", "b"))
    pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs")

    # the sets of those classes, of one text each
    need = pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).unionByName(buckets.where("m > 2").select("k")).distinct()
    one = own.groupBy("k").agg(F.min(F.struct(F.col("doc_id").alias("d"), F.col("h").alias("h"))).alias("r")).join(need, "k", "left_semi")
    one = materialize(one.select("k", F.col("r.d").alias("r_d"), F.col("r.h").alias("r_h")), "near-needed")
    texts = keyed.join(one, F.col("doc_id").eqNullSafe(F.col("r_d")) & (F.col("h") == F.col("r_h"))).select("k", "text")
    sets = materialize(texts.mapInArrow(_sets(width), "k binary, own array<long>").dropDuplicates(["k"]), "near-sets")

    both = pairs.join(sets.select(F.col("k").alias("a"), F.col("own").alias("oa")), "a").join(sets.select(F.col("k").alias("b"), F.col("own").alias("ob")), "b")
    common = F.size(F.array_intersect("oa", "ob"))
    similar = common >= F.lit(similarity) * (F.size("oa") + F.size("ob") - common) - F.lit(1e-9)
    found = materialize(both.where(similar).select("a", "b"), "near-links")

    # buckets whose classes are of several groups
    roots, root = _roots(found, F.col("k"))
    rows = buckets.where("m > 2").select("key", "k", "m").join(roots, F.col("k") == F.col("_node"), "left").select("key", "k", "m", root.alias("root"))
    rows = materialize(rows, "near-rooted")
    open_ = rows.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("key")
    rows = rows.join(open_, "key", "left_semi")
    mine = F.pmod(F.xxhash64("k"), F.col("g")).cast("int")
    dealt = rows.withColumn("g", F.ceil(F.col("m") / block).cast("int")).withColumn("i", mine).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    dealt = dealt.select(F.when(F.col("g") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j"))).alias("key"), "k", "root")
    dealt = dealt.join(sets, "k").select("key", "k", "root", "own").repartition(wide(spark), "key").sortWithinPartitions("key")
    more = materialize(dealt.mapInArrow(_across(similarity), "a binary, b binary"), "near-links")

    if not more.isEmpty():
        roots, root = _roots(found.unionByName(more), F.col("k"))
    return own.select("doc_id", "h", "k").join(roots, F.col("k") == F.col("_node"), "left").select("doc_id", "h", root.alias("grp"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, most: int = 4, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all their columns, that have the smallest doc_id of their group; see ``similar_groups``.

    Of rows that repeat that doc_id one stays, and of a group without any doc_id one row; which of equals is not told. An id may stand
    for several rows, so a row is told by its id and its text's hash.
    """
    groups = materialize(similar_groups(docs, id_col, text_col, width, similarity, most, block), "near-groups")
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("h").alias("h"))
    least = groups.groupBy("grp").agg(F.min(place).alias("least"), F.max(place).alias("final"), F.count(F.lit(1)).alias("c")).where("c > 1")
    lost = heavy_join(groups, materialize(least, "near-least"), ["grp"]).select("doc_id", "h", (place == F.col("least")).alias("stays"))
    lost = materialize(lost.groupBy("doc_id", "h").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("c")).where("not stays or c > 1"), "near-lost")
    text, row = whole_text(text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"))
    gone = lost.select(F.col("doc_id").alias("l_id"), F.col("h").alias("l_h"))
    same = F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("h") == F.col("l_h"))
    out = keyed.join(gone, same, "left_anti").select("row.*")
    again = lost.where("stays").select(F.col("doc_id").alias("l_id"), F.col("h").alias("l_h"))
    if not again.isEmpty():  # rows that repeat both id and text: one of each
        out = out.unionByName(keyed.join(again, same, "left_semi").dropDuplicates(["doc_id", "h"]).select("row.*"))
    return out
