"""Packing of tokenised documents into sequences by linear grouping, then best fit."""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, small_reads, whole_text, wide

#: Split pattern that the library's byte-level pre-tokenizer stands for (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """How byte-level tokenizers write bytes as letters: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _require_plain(spec: dict) -> None:
    """Byte-level BPE without normalizer, affixes, dropout and prefix space, whose merges stand in the order of their ids."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain &= split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True) and spec.get("normalizer") is None and spec.get("truncation") is None
    made = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    if not plain or None in made or any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("the tokenizer file is no plain byte-level BPE with merges in the order of their ids")


@lru_cache(maxsize=2)
def encoder(path: str):
    """texts -> arrays of ids, for the byte-level BPE file at ``path`` of the ``tokenizers`` library.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``: none is added, and a special token's string
    within a text is that token. The file's vocabulary is run by a faster BPE core; texts with an added token go to the
    library itself, and each call holds its whole text of middle length against it and stops at any difference. A file with
    settings that this core doesn't have is refused.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    _require_plain(spec)
    letters = _byte_letters()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(path)

    def encode(texts: list[str]) -> Iterator[np.ndarray]:
        own = [not any(a in t for a in added) for t in texts]
        plain = sorted((t for t, o in zip(texts, own) if o), key=len)
        if plain:
            probe = plain[len(plain) // 2]
            if fast.encode_ordinary(probe) != exact.encode(probe, add_special_tokens=False).ids:
                raise ValueError(f"the two cores disagree on {probe[:80]!r}")
        for t, o in zip(texts, own):
            yield np.array(fast.encode_ordinary(t) if o else exact.encode(t, add_special_tokens=False).ids, "<u4")

    return encode


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Each document's ids, ended by ``end_id``, in pieces of at most ``capacity``: the first may be shorter, the others are full.

    Returns doc_id, piece, start, length, ids_crc32 (of the little-endian 32-bit ids) and, if asked for, ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, ids in enumerate(encode([x.as_py() for x in b.column(1)])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                    for k, (p, q) in enumerate(zip(edges, edges[1:])):
                        row.append(i)
                        piece.append(k)
                        start.append(p)
                        length.append(q - p)
                        crc.append(zlib.crc32(ids[p:q].tobytes()))
                        if keep_ids:
                            kept.append(ids[p:q].astype(np.int64))
                cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array(kept, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, schema)


#: Groups of equal cardinality that large lengths are rounded up in. Large are those over a third of the capacity, so a pattern has two at most.
GROUPS = 64
#: Rows that a task places and writes, where there are enough for every core.
ROWS = 100_000


def configurations(sizes: list[int], counts: list[int], capacity: int, steps: int = 20_000) -> list[tuple[list[int], float]]:
    """The linear programme of the few sizes: (how many of each size, sequences) of the patterns that hold all counts in the fewest sequences.

    Solved by column generation: a pattern enters that is worth most at the current prices, a knapsack over the sizes, until none is
    worth more than a sequence. ``steps`` only ends a run that makes no progress; any stage of it is a valid mix of patterns.
    """
    n = len(sizes)
    s, d = np.array(sizes), np.array(counts, float)
    columns = np.diag(capacity // s).astype(float)
    deepest = int(capacity // s.min())
    value_of = np.zeros((deepest + 1, capacity + 1))
    choice = np.zeros((deepest + 1, capacity + 1), np.int64)
    at = np.arange(capacity + 1)[None, :] - s[:, None]
    for _ in range(steps):
        inverse = np.linalg.inv(columns)
        x, price = inverse @ d, inverse.sum(0)
        for k in range(1, deepest + 1):  # patterns of k documents at most
            worth = np.where(at >= 0, value_of[k - 1][np.maximum(at, 0)] + price[:, None], -1.0)
            choice[k] = best = worth.argmax(0)
            more = worth[best, np.arange(capacity + 1)]
            value_of[k] = np.maximum(more, value_of[k - 1])
            choice[k][more <= value_of[k - 1] + 1e-12] = -1
        if value_of[deepest][capacity] <= 1 + 1e-7:
            break
        pattern, room = np.zeros(n), capacity
        for k in range(deepest, 0, -1):
            if (i := choice[k][room]) >= 0:
                pattern[i] += 1
                room -= s[i]
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        columns[:, int(ratio.argmin())] = pattern
    return [(columns[:, j].astype(int).tolist(), float(v)) for j, v in enumerate(np.linalg.inv(columns) @ d) if v > 0]


class Plan:
    """Where documents go, told by length and rank among those of the same length.

    ``rows``: (length, first rank, ranks, sequence of the first, offset); the sequences that follow take the
    ranks that follow. Everything is counted by length, so the plan's size depends on the capacity alone.
    """

    def __init__(self, counts: dict[int, int], capacity: int = 1024, groups: int = GROUPS, small: int | None = None):
        self.capacity, self.rows, self.sequences = capacity, [], 0
        small = capacity // 3 if small is None else small
        self._taken: dict[int, int] = {}
        self._room: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, sequences)
        if full := counts.get(capacity):
            self._put(capacity, full, self._open(full), 0)
        large = {s: c for s, c in counts.items() if small < s < capacity and c}
        self._configurations(large, groups)
        self._best_fit({s: c for s, c in counts.items() if 0 < s <= min(small, capacity - 1) and c})

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _put(self, length: int, n: int, sequence: int, offset: int) -> None:
        at = self._taken.get(length, 0)
        self.rows.append((length, at, n, sequence, offset))
        self._taken[length] = at + n

    def _configurations(self, counts: dict[int, int], groups: int) -> None:
        """Rounds lengths up within groups of equal cardinality and optimises the patterns of the few rounded sizes together; then actual
        documents take their places, as large ones as the actual room allows, so what rounding has wasted is used again."""
        total = sum(counts.values())
        share, sizes = max(1, -(-total // groups)), {}
        before = 0
        for s in sorted(counts, reverse=True):  # a group's size is that of its first, largest document
            c = counts[s]
            while c:
                n = min(c, share - before % share)
                if before % share == 0:
                    size = s
                sizes[size] = sizes.get(size, 0) + n
                before += n
                c -= n
        left = dict(counts)
        if sizes:
            patterns = configurations(list(sizes), list(sizes.values()), self.capacity)
            slots = [([size for size, m in zip(sizes, pattern) for _ in range(m)], int(times + 1e-6)) for pattern, times in patterns]
            for pattern, times in sorted(slots, reverse=True):
                self._fill(pattern, times, left)
        if left:  # what whole patterns leave
            self._fill([self.capacity] * (self.capacity // min(left)), sum(left.values()), left)

    def _fill(self, slots: list[int], times: int, left: dict[int, int]) -> None:
        """Up to ``times`` sequences of a pattern: in its first place the largest document left that its size admits, in each further
        one, and beyond the pattern, the largest that the room does. Sequences alike are made at once."""
        lengths = sorted(left)
        while times and lengths:
            taken, room = [], self.capacity
            while True:
                k = bisect_right(lengths, room if taken else slots[0]) - 1
                while k >= 0 and taken.count(lengths[k]) >= left[lengths[k]]:
                    k -= 1
                if k < 0:
                    break
                taken.append(lengths[k])
                room -= lengths[k]
            if not taken:
                return
            n = min(times, *(left[s] // taken.count(s) for s in taken))
            first, offset = self._open(n), 0
            for s in taken:
                self._put(s, n, first, offset)
                offset += s
                left[s] -= n
            for s in set(taken):
                if not left[s]:
                    del left[s]
                    lengths.remove(s)
            if room:
                self._room.setdefault(room, []).append((first, n))
            times -= n

    def _best_fit(self, counts: dict[int, int]) -> None:
        """Small lengths, largest first, each to the sequence with the least room that holds it."""
        rooms = sorted(self._room)
        for s in sorted(counts, reverse=True):
            c = counts[s]
            while c:
                k = bisect_left(rooms, s)
                if k == len(rooms):
                    n = -(-c // (self.capacity // s))
                    self._room[self.capacity] = [(self._open(n), n)]
                    rooms.append(self.capacity)
                room = rooms[k]
                runs, rest = self._room.pop(room), []
                rooms.pop(k)
                less = self._room.setdefault(room - s, []) if room > s else None
                if less is not None and not less:
                    rooms.insert(bisect_left(rooms, room - s), room - s)
                for first, n in runs:
                    use = min(n, c)
                    if use:
                        self._put(s, use, first, self.capacity - room)
                        c -= use
                        if less is not None:
                            less.append((first, use))
                    if use < n:
                        rest.append((first + use, n - use))
                if rest:
                    self._room[room] = rest
                    rooms.insert(bisect_left(rooms, room), room)


def pack(pieces: DataFrame, capacity: int = 1024, groups: int = GROUPS, small: int | None = None, salts: int | None = None) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ...) -> the same rows with sequence_id and offset.

    A piece of full length is a sequence, of a negative number. For the others the driver sees one count per length, ``capacity`` numbers at most, and sends
    back a plan whose size has the same bound. They find their place by their rank among those of the same length; the ranks
    are dealt over ``salts`` parts of each length, so a length that very many documents have is no hot spot. Places are given and written by as
    many tasks as the rows need: each file costs a task's start and processes of its own, however many the shuffle partitions.
    """
    spark = pieces.sparkSession
    salts = salts or max(64, wide(spark))
    counts = {r[0]: r[1] for r in pieces.groupBy(F.least("length", F.lit(capacity)).alias("length")).count().collect()}
    weight = sum(n * (1 + s // 8) for s, n in counts.items()) if "ids" in pieces.columns else sum(counts.values())  # eight ids weigh as much as a row
    tasks = max(spark.sparkContext.defaultParallelism, -(-weight // ROWS))
    counts.pop(capacity, None)
    whole = pieces.where(F.col("length") >= capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pieces = pieces.where(F.col("length") < capacity)
    plan = Plan(counts, capacity, groups, small)
    table = np.array(sorted(plan.rows), np.int64).reshape(-1, 5)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    # lengths times salts rows
    before = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "_salt", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(own) - 1).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    ranked = ranked.select(*pieces.columns, "_rank")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    at = pieces.columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = table[:, 0] << 40 | table[:, 1]
        for b in batches:
            length, rank = b.column(at).to_numpy(zero_copy_only=False), b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            k = np.searchsorted(starts, length << 40 | rank, "right") - 1
            sequence, offset = table[k, 3] + rank - table[k, 1], table[k, 4]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return whole.coalesce(tasks).unionByName(ranked.coalesce(tasks).mapInArrow(place, f"{kinds}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, groups: int = GROUPS) -> DataFrame:
    """Packs all documents into as few sequences of at most ``capacity`` tokens as it can.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for). Large lengths are rounded up within ``groups`` groups of equal cardinality; a linear programme finds the patterns that fill
    sequences with those few sizes; actual documents, none longer than its size, take the places; the small ones go where they fit best.

    Null and empty texts are the end id alone. Null doc_ids and repeated rows are packed as often as they come; no
    rows give no rows; a text of any length is cut, never dropped; other columns are ignored.
    """
    with small_reads(docs.sparkSession):
        pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    return pack(pieces, capacity, groups)
