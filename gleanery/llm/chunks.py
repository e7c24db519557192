"""Substring deduplication by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, wide

SLICE = 1 << 20


def _gear() -> np.ndarray:
    """A 32-bit number for each byte, from a multiplicative rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def _rolling(b: np.ndarray) -> np.ndarray:
    """Gear hash at each byte: h = 2 h + gear(byte) in 32 bits, so of the last 32 bytes."""
    h = _GEAR[b]
    for step in (1, 2, 4, 8, 16):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def chunk_ends(data: bytes, least: int = 32, bits: int = 6, most: int = 256) -> list[int]:
    """Where chunks end: after a byte whose hash has ``bits`` leading zeros, ``least`` bytes or more after the last end, at ``most``
    bytes otherwise; never within a UTF-8 sequence."""
    n, ends, last = len(data), [], 0
    raw = np.frombuffer(data, np.uint8)
    marks = []
    for lo in range(0, n, SLICE):
        skip = min(lo, 31)
        h = _rolling(raw[lo - skip : lo + SLICE])[skip:]
        marks.append(np.flatnonzero(h >> np.uint32(32 - bits) == 0) + lo + 1)
    for e in [*(np.concatenate(marks).tolist() if marks else []), n]:
        while e - last > most:
            cut = last + most
            while cut > last + 1 and data[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
        if e == n or e - last >= least and data[e] & 0xC0 != 0x80:
            if e > last:
                ends.append(e)
            last = e
    return ends


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 32, bits: int = 6, most: int = 256) -> DataFrame:
    """(k1, k2, doc_id, text_hash, start): digest and place of every chunk of ``least`` bytes or more of every whole text."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, digest, start = [], [], []
            for i, t in enumerate(b.column(2)):
                data, at = t.as_py().encode("utf-8", "surrogatepass"), 0
                for e in chunk_ends(data, least, bits, most):
                    if e - at >= least:
                        row.append(i)
                        digest.append(xxhash.xxh3_128_digest(data[at:e]))
                        start.append(at)
                    at = e
            k = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(k[:, 0]), pa.array(k[:, 1]), b.column(0).take(take), b.column(1).take(take), pa.array(start, pa.int32())], names=["k1", "k2", "doc_id", "text_hash", "start"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, f"k1 long, k2 long, doc_id {kind}, text_hash long, start int")


#: Documents of which the common chunks are taken.
SAMPLE = 20_000


def _common(docs: DataFrame, id_col: str, text_col: str, least: int, bits: int, most: int, share: int = 4) -> DataFrame:
    """(k1, k2) of the chunks that have more than one in ``share`` times the partitions of a sample's places, which so many have at most."""
    spark = docs.sparkSession
    part = docs.sample(min(1.0, SAMPLE / max(1, docs.count())), seed=1)
    counts = materialize(chunk_table(part, id_col, text_col, least, bits, most).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "chunk-sample")
    total = counts.agg(F.sum("c")).first()[0] or 0
    return counts.where(F.col("c") > total / (share * wide(spark))).select("k1", "k2")


def dedup_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 32, bits: int = 6, most: int = 256) -> DataFrame:
    """Removes every chunk whose digest also stands earlier, by (doc_id, place), in this or another text.

    One row per input row: doc_id, text (what is left), n_bytes, n_removed, n_spans (maximal removed runs). Boundaries depend on the 32 bytes
    before them, so an insertion shifts one or two chunks only and the others are found again. Digests have 128 bits. Places are
    ranked in one exchange of ids and digests, so small chunks are affordable; those of a very common chunk are ranked in as many parts as there
    are partitions, and then the first of each part among themselves. Which chunks are that common a sample tells, which steers the work alone.

    Chunks shorter than ``least`` bytes (ends of texts) always stay. Null text counts as empty. Null doc_ids come last in the order. Rows that
    repeat both doc_id and text are one place and fare alike. No rows give no rows; other columns are ignored.
    """
    key, order = ["k1", "k2"], [F.col("doc_id").asc_nulls_last(), F.col("text_hash"), F.col("start")]
    heavy = _common(docs, id_col, text_col, least, bits, most).select(*key, F.lit(wide(docs.sparkSession)).alias("parts"))
    each = chunk_table(docs, id_col, text_col, least, bits, most).join(F.broadcast(heavy), key, "left")
    each = each.withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc_id", "text_hash"), F.col("parts")), F.lit(0).cast("long")))
    each = each.withColumn("place", F.rank().over(Window.partitionBy(*key, "part").orderBy(*order)))
    found = materialize(each.where((F.col("place") > 1) | F.col("parts").isNotNull()), "chunk-places")
    firsts = found.where("place = 1").withColumn("place", F.rank().over(Window.partitionBy(*key).orderBy(*order)))
    later = found.where("place > 1").unionByName(firsts.where("place > 1"))
    marks = later.groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash")).agg(F.collect_set("start").alias("starts"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    left = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    both = left.join(marks, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.xxhash64("text") == F.col("m_hash")), "left")

    def cut(t: str | None, starts: list[int] | None) -> dict | None:
        if t is None:
            return None
        data, gone, at, kept, spans, removed = t.encode("utf-8", "surrogatepass"), set(starts), 0, [], 0, False
        for e in chunk_ends(data, least, bits, most):
            if at in gone:
                spans += not removed
                removed = True
            else:
                kept.append(data[at:e])
                removed = False
            at = e
        left_over = b"".join(kept)
        return {"text": left_over.decode("utf-8", "surrogatepass"), "n_removed": len(data) - len(left_over), "n_spans": spans}

    cutter = F.udf(cut, "text string, n_removed long, n_spans int", useArrow=True)
    done = both.select("doc_id", F.col("text").alias("whole"), cutter(F.when(F.col("starts").isNotNull(), F.col("text")), "starts").alias("c"))
    return done.select("doc_id", F.coalesce("c.text", "whole").alias("text"), F.octet_length("whole").cast("long").alias("n_bytes"), F.coalesce("c.n_removed", F.lit(0)).alias("n_removed"), F.coalesce("c.n_spans", F.lit(0)).alias("n_spans"))
