"""Line deduplication by winnowing over line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, heavy_join, materialize

SPACE = b" \t\n\x0b\x0c\r"


def line_hashes(text: str) -> tuple[list[bytes], list[int]]:
    """128-bit digests and 64-bit hashes of the non-blank lines, white space at their ends aside."""
    lines = [x for x in (t.strip(SPACE) for t in text.encode("utf-8", "surrogatepass").split(b"\n")) if x]
    return [xxhash.xxh3_128_digest(x) for x in lines], [xxhash.xxh64_intdigest(x, 7) - (1 << 63) for x in lines]


def line_windows(full: list[bytes], short: list[int], min_lines: int) -> list[tuple[int, list[tuple[bytes, int]]]]:
    """Winnowed fingerprints of a text: (line hash, windows around it), a window being (digest, its first line).

    Lines are counted without blank ones. Each window of ``min_lines`` lines selects its least line hash, the last of equal
    ones; windows in a row that select the same line are one fingerprint. The choice depends on the window's
    lines alone, so two equal windows select the same line wherever they stand.
    """
    out: list[tuple[int, list]] = []
    last = -1
    for s in range(len(full) - min_lines + 1):
        at = min(range(s, s + min_lines), key=lambda i: (short[i], -i))
        if at != last:
            out.append((short[at], []))
            last = at
        out[-1][1].append((xxhash.xxh3_128_digest(b"".join(full[s : s + min_lines])), s))
    return out


def _extend(own: list[int], first: list[int], seeds: list, min_lines: int) -> list[int]:
    """The lines of the runs that matching windows at (line, line in the first place) extend to, both ways while lines agree."""
    gone: set[int] = set()
    done: dict[int, int] = {}  # of each diagonal, the line up to which it is followed
    for s, f in sorted((x["s"], x["f"]) for x in seeds):
        if done.get(f - s, 0) > s:
            continue
        lo, hi = s, s + min_lines
        while lo and lo + f - s and own[lo - 1] == first[lo + f - s - 1]:
            lo -= 1
        while hi < len(own) and hi + f - s < len(first) and own[hi] == first[hi + f - s]:
            hi += 1
        done[f - s] = hi
        gone.update(range(lo, hi))
    return sorted(gone)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 1) -> DataFrame:
    """(doc_id, text_hash, lines): the lines of later repeated runs, counted without blank ones, per document that has any."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    prints = pa.list_(pa.struct([("fp", pa.int64()), ("windows", pa.list_(pa.struct([("key", pa.binary()), ("s", pa.int32())])))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            hashes, found = [], []
            for t in b.column(2):
                full, short = line_hashes(t.as_py())
                hashes.append(short if min_lines > 1 else [])
                found.append([{"fp": fp, "windows": [{"key": k, "s": s} for k, s in w]} for fp, w in line_windows(full, short, min_lines)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hashes, pa.list_(pa.int64())), pa.array(found, prints)], names=["doc_id", "text_hash", "hashes", "prints"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    if min_lines > 1:  # shorter texts have no window; of one line, a text without a break is one
        texts = texts.where(F.instr("text", "\n") > 0)
    marks = materialize(texts.mapInArrow(run, f"doc_id {kind}, text_hash long, hashes array<long>, prints array<struct<fp:long,windows:array<struct<key:binary,s:int>>>>"), "line-fingerprints")

    # fingerprints that stand once can't repeat; positions of the others are joined to the first of the same window
    each = marks.select("doc_id", "text_hash", F.explode("prints").alias("p")).select("doc_id", "text_hash", "p.fp", "p.windows")
    hot = materialize(each.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "line-hot")
    near = heavy_join(each, hot, ["fp"], how="left_semi").select("doc_id", "text_hash", F.explode("windows").alias("w")).select("doc_id", "text_hash", "w.key", "w.s")
    near = materialize(near, "line-positions")
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("s").alias("s"))
    first = near.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("final"), F.count(F.lit(1)).alias("c")).where("first < final").drop("final")
    later = heavy_join(near, materialize(first, "line-firsts"), ["key"]).where(place > F.col("first"))
    if min_lines == 1:  # a window is a line, so each line of a run is found by itself
        return later.groupBy("doc_id", "text_hash").agg(F.collect_set("s").alias("lines"))

    lines = marks.select("doc_id", "text_hash", "hashes").dropDuplicates(["doc_id", "text_hash"])
    seeds = later.groupBy("doc_id", "text_hash", F.col("first.d").alias("f_id"), F.col("first.t").alias("f_hash")).agg(F.collect_set(F.struct("s", F.col("first.s").alias("f"))).alias("seeds"))
    own, other = (lines.select(F.col("doc_id").alias(f"{x}_d"), F.col("text_hash").alias(f"{x}_t"), F.col("hashes").alias(x)) for x in ("own", "other"))
    both = seeds.join(own, F.col("doc_id").eqNullSafe(F.col("own_d")) & (F.col("text_hash") == F.col("own_t"))).join(other, F.col("f_id").eqNullSafe(F.col("other_d")) & (F.col("f_hash") == F.col("other_t")))
    extend = F.udf(lambda a, b, s: _extend(a, b, s, min_lines), "array<int>", useArrow=True)
    runs = both.select("doc_id", "text_hash", F.explode(extend("own", "other", "seeds")).alias("line"))
    return runs.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("lines"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 1) -> DataFrame:
    """Deletes later repeated runs of lines; every input row with its columns, in a struct ``row``, and the outcome.

    Returns row (the columns as they came), doc_id, text (what is left), n_lines, n_removed, n_runs (maximal runs of
    removed lines, blank lines between them included in neither count).

    A run is ``min_lines`` or more lines in a row, blank ones passed over and white space at the ends ignored; with 1, any line that
    stands earlier goes, that of a one-line text too, with more a repeated line whose neighbours differ stays. A line goes
    if it is within a run that also stands earlier, by (doc_id, line number), in this or another document. Fingerprints, the least
    line hashes of windows, that occur once are left out; the windows around the others are joined by their 128-bit digests to the first
    position of each, and from there a match is extended both ways as long as line hashes agree.

    Null text counts as empty (and comes back as ""); shorter texts than ``min_lines`` lines stay as they are. Null doc_ids come
    last in the order. Rows that repeat both doc_id and text are one place and fare alike; with the same doc_id and
    other text the order is that of the texts' hash. No rows give no rows; other columns may have any names.
    """
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    marks = repeated_lines(docs, id_col, text_col, min_lines).withColumnsRenamed({"doc_id": "m_id", "text_hash": "m_hash"})
    text = F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))
    own = docs.toDF(*names.values())  # the text once, however often it is named
    both = own.join(marks, F.col(names[id_col]).eqNullSafe(F.col("m_id")) & (F.xxhash64(text) == F.col("m_hash")), "left")
    cut = F.udf(_cut, "text string, n_lines int, n_removed int, n_runs int", useArrow=True)
    row = F.struct(*[F.col(n).alias(c) for c, n in names.items()])
    done = both.select(row.alias("row"), F.col(names[id_col]).alias("doc_id"), text.alias("whole"), cut(F.when(F.col("lines").isNotNull(), text), "lines").alias("cut"))
    return done.select("row", "doc_id", F.coalesce("cut.text", "whole").alias("text"), F.coalesce("cut.n_lines", _nonblank("whole")).alias("n_lines"), F.coalesce("cut.n_removed", F.lit(0)).alias("n_removed"), F.coalesce("cut.n_runs", F.lit(0)).alias("n_runs"))


def _nonblank(text: str) -> Column:
    return F.size(F.filter(F.split(F.col(text), "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))


def _cut(text: str | None, gone: list[int] | None) -> dict | None:
    if text is None:
        return None
    gone, kept, n, runs, before = set(gone), [], 0, 0, False
    for line in text.split("\n"):
        blank = not line.strip(" \t\n\x0b\x0c\r")
        if not blank and n in gone:
            runs += not before
            before = True
        else:
            kept.append(line)
            before = before and blank
        n += not blank
    return {"text": "\n".join(kept), "n_lines": n, "n_removed": len(gone), "n_runs": runs}
