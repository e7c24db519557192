"""Word shingles of whole texts as sets of 64-bit hashes, worked out once per text in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import bounded_batches

_OTHER = re.compile(r"[^a-z0-9:./@-]+")


def shingle_hashes(text: str | None, width: int = 3) -> np.ndarray:
    """Distinct XXH64 hashes, in order, of the runs of ``width`` words over [a-z0-9:./@-]; none for fewer words."""
    w = _OTHER.sub(" ", (text or "").lower()).strip(" ").split(" ")
    if len(w) < width:
        return np.zeros(0, np.int64)
    joined = " ".join(w).encode()
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(w) - width + 1
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist())), np.uint64, n).view(np.int64))


def shingle_table(rows: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, digest, own): a 128-bit digest of each text's set of shingles, and the set as a sorted array of hashes."""
    bounded_batches(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                own = [shingle_hashes(t.as_py(), width) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in own], pa.binary()), pa.array(own, pa.list_(pa.int64()))], names=["id", "digest", "own"])

    return rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, digest binary, own array<long>")
