"""SimHash near-duplicates, found by Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golay
from .common import bounded_batches, materialize, whole_text, wide
from .components import components

#: Segments of a fingerprint as (lowest bit, bits).
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Fingerprints of a key that one task compares; the rest is dealt out in pairs of blocks.
BLOCK = 20_000
_SLICE = 1 << 16


def shingle_hashes(text: str, width: int = 4, seed: int = 42) -> np.ndarray:
    """XXH64 of each ``width``-word shingle, repeats included; of fewer words the whole sequence's, of none none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[len(words) - n :].tolist())), np.uint64, n)


def set_bits(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set; zero for none."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        count += np.unpackbits(hashes[at : at + _SLICE].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, width: int = 4, seed: int = 42) -> int:
    """SimHash of the ``width``-word shingles, as an unsigned 64-bit integer; see ``fingerprints``."""
    return set_bits(shingle_hashes(text, width, seed))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a long) of every row, from its whole text.

    A-Z are lower-cased, words are runs of other than ASCII white space, and each of the ``width``-word
    shingles, repeats included, votes with its XXH64. With fewer words the whole sequence is the only
    shingle; a null or empty text has fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, width) for t in (x.as_py() for x in b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) pairs such that any two fingerprints at four or fewer differing bits have a common key.

    The errors of the three segments, sorted, are (0, <= 2, any) or (1, 1, <= 2). So either one segment
    is equal and another within two errors, which a Golay index of both balls tells (6 kinds of key); or one
    segment is within two errors and each of the others has an equal half (12 kinds). Keys have 30 bits
    at least besides their kind, so buckets stay small however many fingerprints there are.
    """
    seg = [(fp >> np.uint64(lo)) & np.uint64((1 << bits) - 1) for lo, bits in SEGMENTS]
    balls = [golay.ball(s, bits) for s, (_, bits) in zip(seg, SEGMENTS)]
    halves = [[s & np.uint64((1 << bits // 2) - 1), s >> np.uint64(bits // 2)] for s, (_, bits) in zip(seg, SEGMENTS)]
    at, keys, kind = [], [], 0
    for j, (found, fresh) in enumerate(balls):
        i, c = np.nonzero(fresh)
        near = found[i, c].astype(np.int64)
        others = [k for k in range(3) if k != j]
        rest = [seg[k] for k in others]
        rest += [a << np.uint64(12) | b for a in halves[others[0]] for b in halves[others[1]]]
        for x in rest:
            at.append(i)
            keys.append(near << 24 | x[i].astype(np.int64) | kind << 40)
            kind += 1
    return np.concatenate(at), np.concatenate(keys)


def _forest(f: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever links within ``f`` connect: one fewer than each component has members."""
    out, left = [], f
    while left.size > 1:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            u = queue.pop()
            near = np.bitwise_count(left ^ u) <= most
            if near.any():
                v = left[near]
                out.append((np.full(v.size, u), v))
                queue.extend(v)
                left = left[~near]
    return out


def _bucket_links(most: int, block: int | None):
    """Over rows (key..., fp) sorted by key: links as kind 0; rows of keys with more than ``block`` fingerprints as kind 1."""

    def solve(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, key.size))
        links: list[tuple[np.ndarray, np.ndarray]] = []
        small = np.repeat(size, size) <= 4
        for step in (1, 2, 3):
            a, b = fp[:-step], fp[step:]
            same = (key[:-step] == key[step:]) & small[step:]
            same[same] = np.bitwise_count(a[same] ^ b[same]) <= most
            links.append((a[same], b[same]))
        over: list[tuple[np.ndarray, np.ndarray]] = []
        for s, n in zip(first[size > 4].tolist(), size[size > 4].tolist()):
            if block and n > block:
                over.append((key[s : s + n], fp[s : s + n]))
            else:
                links += _forest(np.unique(fp[s : s + n]), most)
        a, b = (np.concatenate([x[i] for x in links]) for i in (0, 1))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        k = np.concatenate([x[0] for x in over]) if over else np.zeros(0, np.int64)
        f = np.concatenate([x[1] for x in over]) if over else np.zeros(0, np.uint64)
        kind = np.concatenate([np.zeros(len(pairs), np.int8), np.ones(len(k), np.int8)])
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([pairs[:, 0].view(np.int64), k])), pa.array(np.concatenate([pairs[:, 1], f]).view(np.int64))], names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            key, fp = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not key.size:
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if cut or (held and held[-1][0][-1] != key[0]):
                held.append((key[:cut], fp[:cut]))
                yield solve(*(np.concatenate([x[i] for x in held]) for i in (0, 1)))
                held = []
            held.append((key[cut:], fp[cut:]))
        if held:
            yield solve(*(np.concatenate([x[i] for x in held]) for i in (0, 1)))

    return run


def links(fps: DataFrame, most: int = 4, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) whose closure is that of all pairs at ``most`` or fewer differing bits."""
    if most > 4:
        raise ValueError("the keys hold for four differing bits at most")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                fp = b.column(0).slice(at, 2000).to_numpy(zero_copy_only=False).view(np.uint64)
                i, key = fuzzy_keys(fp)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[i].view(np.int64))], names=["key", "fp"])

    n = wide(fps.sparkSession)
    # dealt out before they grow to 96 rows each: a file of fingerprints is small, its keys are not
    rows = fps.repartition(n, "fp").mapInArrow(keyed, "key long, fp long").repartition(n, "key").sortWithinPartitions("key", "fp")
    found = materialize(rows.mapInArrow(_bucket_links(most, block), "kind byte, a long, b long"), "simhash-links")
    out, over = found.where("kind = 0").select("a", "b"), found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if not over.isEmpty():
        # blocks by the fingerprint, each pair of blocks of a key a bucket of its own
        parts = over.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("g"))
        mine = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
        dealt = over.join(parts, "key").select("key", "fp", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("j"))
        dealt = dealt.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp").repartition(n, "key").sortWithinPartitions("key", "fp")
        out = out.unionByName(dealt.mapInArrow(_bucket_links(most, None), "kind byte, a long, b long").select("a", "b"))
    return out.distinct()


def _classes(own: DataFrame, most: int, block: int) -> DataFrame:
    """(doc_id, fp) -> one row per fingerprint: fp, component_id, component_size."""
    nodes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), most, block))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", "copies", F.coalesce("root", "fp").alias("root"))
    by_root = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("component_size"))
    return placed.select("fp", "root").join(by_root, "root").select("fp", "component_id", "component_size")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, most: int = 4, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 lower-case hex digits), component_id, component_size.

    component_id is the smallest doc_id that links reach, the row's own included; links join fingerprints
    at ``most`` or fewer differing bits. Copies share a fingerprint and count as one in the search, which
    works on distinct fingerprints; it emits a spanning forest of each bucket, never all its pairs.

    Null and empty texts have fingerprint zero and are linked like any other. A null doc_id gets the
    smallest other doc_id of its component (null if it has none). Repeated rows come back as often as they
    came; no rows give no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    own = materialize(fingerprints(docs, id_col, text_col, width), "simhash")
    named = _classes(own, most, block)
    return own.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")
