"""Repeated passages across documents, by common-prefix interval trees of enhanced suffix arrays.

A passage of ``width`` bytes belongs to the bucket of the least hash among its strings of 32 bytes (16 where it is short itself), so all
places of a passage meet in one bucket; strings that long are seldom common but within repeats. Consecutive passages with the same least hash travel as one string. Each bucket
builds an enhanced suffix array over its distinct strings and scans it with a stack.

Texts stay where they are: they are stored once, in blocks, and tasks exchange packed messages, one per block and bucket. A
message holds each string once, however many documents of the block have it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, heavy_join, materialize, scratch, whole_text, wide

#: Bytes of a passage at least, and of the strings that are hashed within passages of 48 bytes or more.
GRAM, LONG_GRAM = 16, 32
BLOCK = 2 << 20
#: Bytes of text for each bucket, however many there are; with more partitions buckets are smaller.
BUCKET = 16 << 20
#: Passages that travel together at most, and windows hashed at once.
RUN, SLICE = 64, 1 << 20
#: Stands for a null id, which is no document's smaller one.
LAST = np.iinfo(np.int64).max

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def least_hashes(b: np.ndarray, width: int) -> np.ndarray:
    """For each passage of ``width`` bytes, the least hash of its strings."""
    gram = LONG_GRAM if width >= LONG_GRAM + GRAM else GRAM
    h = b.astype(np.uint64) + np.uint64(1)
    for step, odd in zip((1, 2, 4, 8, 16), _ODD):
        if step < gram:
            h = h[:-step] * odd + h[step:]
    h ^= h >> np.uint64(31)
    h *= _ODD[4]
    h ^= h >> np.uint64(29)
    left, step = width - gram, 1
    while left:
        step = min(step, left)
        h = np.minimum(h[:-step], h[step:])
        left, step = left - step, step * 2
    return h


def runs(text: bytes, lens: np.ndarray, skip: set[int], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the documents of a block: first passage, passages, key and document of each run of passages with one least hash."""
    raw, ends = np.frombuffer(text, np.uint8), np.cumsum(lens)
    alive = np.zeros(len(raw) + 1, bool)
    for i, (e, n) in enumerate(zip(ends.tolist(), lens.tolist())):
        if n >= width and i not in skip:
            alive[e - n : e - width + 1] = True
    first, size, key = [], [], []
    for lo in range(0, max(0, len(raw) - width + 1), SLICE):
        part = raw[lo : lo + SLICE + width - 1]
        ok = alive[lo : lo + len(part) - width + 1]
        if not ok.any():
            continue
        m = least_hashes(part, width)
        fresh = ok.copy()
        fresh[1:] &= ~ok[:-1] | (m[1:] != m[:-1])
        s = np.flatnonzero(fresh)
        stop = ok.copy()
        stop[:-1] &= ~ok[1:] | fresh[1:]
        n = np.flatnonzero(stop) + 1 - s
        pieces = -(-n // RUN)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first.append(np.repeat(s, pieces) + nth * RUN + lo)
        size.append(np.minimum(np.repeat(n, pieces) - nth * RUN, RUN))
        key.append(np.repeat(m[s], pieces))
    if not first:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    first = np.concatenate(first)
    k = np.concatenate(key) * _ODD[1]
    k ^= k >> np.uint64(32)
    return first, np.concatenate(size), k * _ODD[2], np.searchsorted(ends, first, "right")


class Block:
    """A block's text with its runs, keyed by (bucket, 32 bits of the hash)."""

    def __init__(self, row: dict, width: int, buckets: int):
        self.ids = np.array([LAST if i is None else i for i in row["ids"]], np.int64)
        self.lens = np.array(row["lens"], np.int64)
        system, where = fs.FileSystem.from_uri(row["path"])
        with system.open_input_file(where) as f:
            f.seek(row["offset"])
            self.text = zstandard.decompress(f.read(row["size"]), max_output_size=int(self.lens.sum()) or 1) if row["size"] else b""
        self.copies = set(row["copies"] or ())
        self.first, self.size, k, self.doc = runs(self.text, self.lens, self.copies, width)
        keyed = (k >> np.uint64(33)) % np.uint64(buckets) << np.uint64(32) | k & np.uint64(0xFFFFFFFF)
        self.keys, self.of = np.unique(keyed, return_inverse=True)
        self.edges = np.searchsorted(self.keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        self.width = width

    def many(self) -> np.ndarray:
        """Which keys two documents of this block have."""
        order = np.lexsort((self.doc, self.of))
        of, doc = self.of[order], self.doc[order]
        out = np.zeros(len(self.keys), bool)
        out[of[1:][(of[1:] == of[:-1]) & (doc[1:] != doc[:-1])]] = True
        return out

    def flagged(self, replies: list[dict]) -> np.ndarray:
        """The runs whose key the buckets have seen in two documents, by bucket and place."""
        hit = np.zeros(len(self.keys), bool)
        for r in replies:
            lo, hi = self.edges[r["bucket"] : r["bucket"] + 2]
            hit[lo:hi] = np.unpackbits(np.frombuffer(r["reply"], np.uint8), count=hi - lo).astype(bool)
        at = np.flatnonzero(hit[self.of])
        return at[np.argsort(self.keys[self.of[at]] >> np.uint64(32), kind="stable")]

    def strings(self, at: np.ndarray) -> Iterator[tuple[int, list[bytes], list[list[int]]]]:
        """By bucket: distinct strings of these runs, and the runs of each."""
        bucket = (self.keys[self.of[at]] >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for part in np.split(at, cuts) if len(at) else []:
            place: dict[bytes, int] = {}
            have: list[list[int]] = []
            for i, s, n in zip(part.tolist(), self.first[part].tolist(), self.size[part].tolist()):
                c = self.text[s : s + n + self.width - 1]
                if (k := place.setdefault(c, len(have))) == len(have):
                    have.append([])
                have[k].append(i)
            yield int(self.keys[self.of[part[0]]] >> np.uint64(32)), list(place), have


def sort_suffixes(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Enhanced suffix array of the strings: the suffixes that share ``width`` bytes with another one in order, the common
    prefix of each with the one before (0 if under ``width``), all bytes, and the strings' starts in those.

    Suffixes are split by eight bytes after another; one that is alone, and so shares less, takes no further part.
    """
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    start = np.concatenate([[0], np.cumsum(size)])
    text = np.frombuffer(b"".join([*strings, bytes(8)]), np.uint8)
    words = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    n = np.maximum(size - width + 1, 0)
    at = np.repeat(start[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    group = np.zeros(len(at), np.int64)
    for d in [*range(0, width - 7, 8), width - 8]:
        key = words[at + d].astype(np.uint64)
        order = np.lexsort((key, group)) if d else np.argsort(key)
        at, group, key = at[order], group[order], key[order]
        fresh = _fresh(group, key)
        shared = ~(fresh[1:] & fresh[:-1])
        at, group = at[shared], np.cumsum(fresh[:-1])[shared]
    end = start[np.searchsorted(start, at, "right")]
    full, d, tied = group, width, len(at) > 0
    while tied:  # the order beyond the width: seven bytes at a time, none where a string has ended
        key = sum(np.where(at + d + k < end, text[np.minimum(at + d + k, len(text) - 1)].astype(np.int64) + 1, 0) << 9 * (6 - k) for k in range(7))
        order = np.lexsort((key, group))
        at, end, full, key, group = at[order], end[order], full[order], key[order], group[order]
        fresh = _fresh(group, key)
        tied = bool((~(fresh[1:] & fresh[:-1]) & (key & 511 > 0)).any())
        group = np.cumsum(fresh[:-1])
        d += 7
    lcp = np.zeros(len(at), np.int64)
    pair = np.flatnonzero(full[1:] == full[:-1]) + 1
    lcp[pair] = d = width
    while len(pair):
        a, b = at[pair] + d, at[pair - 1] + d
        ok = (a < end[pair]) & (b < end[pair - 1])
        pair, a, b = pair[ok], a[ok], b[ok]
        pair = pair[text[a] == text[b]]
        d += 1
        lcp[pair] = d
    return at, lcp, text, start


def _fresh(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a new (group, key) begins, and a last True."""
    return np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1]), [True]]) if len(key) else np.ones(1, bool)


def maximal_repeats(sa: np.ndarray, lcp: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Scans the common-prefix intervals with a stack: (length, first, last in the suffix array) of each group that can be
    extended neither to the right, as an interval of its own, nor to the left, as its places have different left symbols.

    ``left`` is the symbol before each suffix, negative and different for each that has none.
    """
    stack: list[list[int]] = []  # length, first, left symbol or None if they differ
    prefix, before = lcp.tolist(), left.tolist()
    for i in range(1, len(prefix) + 1):
        now = prefix[i] if i < len(prefix) else 0
        first, mark = i - 1, before[i - 1]
        while stack and stack[-1][0] > now:
            length, first, own = stack.pop()
            own = own if own == mark else None
            if own is None:
                yield length, first, i - 1
            mark = own
        if now and (not stack or stack[-1][0] < now):
            stack.append([now, first, mark])
        elif stack and stack[-1][2] != mark:
            stack[-1][2] = None


def earliest(strings: list[bytes], owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, set[int]]:
    """For each passage of each string the smallest owner of any string that has it.

    Returns those by passage, the strings' first passages in that, and the strings whose passages have other smallest owners than themselves.
    """
    sa, lcp, text, start = sort_suffixes(strings, width)
    size = np.diff(start) - width + 1  # passages
    first = np.concatenate([[0], np.cumsum(size)])
    best, touched = np.repeat(owner, size), set()
    if len(sa):
        string = np.searchsorted(start, sa, "right") - 1
        offset = sa - start[string]
        left = np.where(offset > 0, text[sa - 1].astype(np.int64), -1 - np.arange(len(sa)))
        own, place, string = owner[string].tolist(), (first[string] + offset).tolist(), string.tolist()
        for length, lo, hi in maximal_repeats(sa, lcp, left):
            least = min(own[lo : hi + 1])
            for k in range(lo, hi + 1):
                if own[k] > least:
                    part = best[place[k] : place[k] + length - width + 1]
                    np.minimum(part, least, out=part)
                    touched.add(string[k])
    return best, first, touched


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    return zstandard.compress(np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts), 1)


def _unpack(data: bytes, *kinds: str | None) -> list:
    raw = zstandard.decompress(data)
    at, out = 8 * len(kinds), []
    for kind, n in zip(kinds, np.frombuffer(raw, np.int64, len(kinds)).tolist()):
        out.append(raw[at : at + n] if kind is None else np.frombuffer(raw[at : at + n], kind))
        at += n
    return out


BLOCKS = "block_id string, path string, offset long, size long, ids array<long>, lens array<long>, digests array<binary>"


def store_blocks(docs: DataFrame, id_col: str, text_col: str, size: int = BLOCK) -> DataFrame:
    """Stores the texts, compressed, in the shared folder; a row per block of ``size`` bytes or one longer text.

    A task lists its own file when it ends well, so what failed attempts leave is never read.
    """
    folder = scratch(docs.sparkSession, "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, done = None, None, 0, []
        texts: list[bytes] = []
        ids: list[int | None] = []
        total = 0

        def flush() -> None:
            nonlocal out, path, at, texts, ids, total
            if not ids:
                return
            if out is None:
                system, root = fs.FileSystem.from_uri(folder)
                system.create_dir(root, recursive=True)
                path = f"{folder}/{uuid.uuid4().hex}"
                out = system.open_output_stream(fs.FileSystem.from_uri(path)[1])
            data = zstandard.compress(b"".join(texts), 1) if total else b""
            out.write(data)
            done.append((uuid.uuid4().hex, path, at, len(data), ids, [len(t) for t in texts], [xxhash.xxh3_128_digest(t) + len(t).to_bytes(6, "big") for t in texts]))
            at += len(data)
            texts, ids, total = [], [], 0

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py().encode("utf-8", "surrogatepass")
                if ids and total + len(t) > size:
                    flush()
                texts.append(t)
                ids.append(i)
                total += len(t)
        flush()
        if out is not None:
            out.close()
        for d in done:
            yield pa.RecordBatch.from_pylist([dict(zip(("block_id", "path", "offset", "size", "ids", "lens", "digests"), d))], schema=_BLOCKS)

    return materialize(docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text")).mapInArrow(run, BLOCKS), "blocks")


_BLOCKS = pa.schema([("block_id", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary()))])


def _with_copies(blocks: DataFrame) -> DataFrame:
    """Adds the places of documents whose whole text a document with a smaller id has."""
    each = blocks.select("block_id", F.posexplode(F.arrays_zip("ids", "digests")).alias("place", "d")).select("block_id", "place", F.coalesce("d.ids", F.lit(int(LAST))).alias("id"), F.col("d.digests").alias("digest"))
    first = each.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("final"), F.count(F.lit(1)).alias("c")).where("first < final").drop("final")
    copies = heavy_join(each, materialize(first, "blocks-firsts"), ["digest"]).where("id > first").groupBy("block_id").agg(F.collect_list("place").alias("copies"))
    return blocks.drop("digests").join(copies, "block_id", "left")


def _by_block(replies: DataFrame, name: str) -> DataFrame:
    return replies.groupBy("block_id").agg(F.collect_list(F.struct("bucket", "reply")).alias(name))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, buckets: int | None = None, contents: bool = True) -> DataFrame:
    """The bytes of each document that a passage of ``width`` bytes covers which also starts in a document with a smaller id.

    One row per input row: doc_id, n_bytes, n_removed, spans (maximal removed runs as start and end), kept (the remaining bytes, if
    ``contents``), kept_sha256. All is judged on the input; repeats within a document alone are none of its concern.

    A text that a document with a smaller id has as a whole, told by its length and a 128-bit xxHash (fast, not made against forgery), goes as a
    whole; only first texts enter the search, so copies make no bucket larger. Buckets grow in number with the bytes, not in size. Texts under ``width`` bytes, empty and null ones (empty bytes) have no passages. Ids are integers; a null id counts as larger
    than any other and not as smaller than another null. Rows that repeat an id fare alike and don't remove each other.
    No rows give no rows; other columns are ignored.
    """
    if width < GRAM:
        raise ValueError(f"passages have {GRAM} bytes at least")
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = materialize(_with_copies(store_blocks(docs, id_col, text_col)), "blocks-copies")
    total = blocks.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = buckets or max(wide(spark), -(-total // BUCKET))
    n = wide(spark)  # the rows are short, but each stands for a block's work
    seen = materialize(_exchange(blocks.repartition(n).mapInArrow(_send_keys(width, buckets), "bucket int, block_id string, payload binary"), buckets, _seen_twice), "passages-seen")
    known = blocks.join(_by_block(seen, "seen"), "block_id", "left")
    found = _exchange(known.repartition(n).mapInArrow(_send_strings(width, buckets), "bucket int, block_id string, payload binary"), buckets, _smallest_owner(width))
    known = known.join(_by_block(found, "found"), "block_id", "left")
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string" + ", kept binary" * contents
    return known.repartition(n).mapInArrow(_cut(width, buckets, contents), schema)


def _exchange(sent: DataFrame, buckets: int, answer) -> DataFrame:
    # a bucket to a task each: hashed, some tasks would get several and others none
    return sent.repartitionById(buckets, F.col("bucket")).groupBy("bucket").applyInArrow(answer, "block_id string, bucket int, reply binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _message(bucket: list, block: list, payload: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(block, pa.string()), pa.array(payload, pa.binary())], names=["bucket", "block_id", "payload"])


def _reply(bucket: int, block: list, reply: list) -> pa.Table:
    return pa.table([pa.array(block, pa.string()), pa.array([bucket] * len(block), pa.int32()), pa.array(reply, pa.binary())], names=["block_id", "bucket", "reply"])


def _send_keys(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = Block(row, width, buckets)
            many, low = b.many(), (b.keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            have = np.flatnonzero(np.diff(b.edges)).tolist()
            cut = [(k, low[b.edges[k] : b.edges[k + 1]], np.packbits(many[b.edges[k] : b.edges[k + 1]])) for k in have]
            yield _message([k for k, _, _ in cut], [row["block_id"]] * len(cut), [keys.tobytes() + bits.tobytes() for _, keys, bits in cut])

    return run


def _sizes(payload: bytes) -> int:
    """Keys in a message of four bytes and a bit for each."""
    return len(payload) * 8 // 33


def _seen_twice(table: pa.Table) -> pa.Table:
    keys, many, size = [], [], []
    for p in table.column("payload"):
        p = p.as_py()
        n = _sizes(p)
        keys.append(np.frombuffer(p, np.uint32, n))
        many.append(np.unpackbits(np.frombuffer(p, np.uint8, offset=4 * n), count=n))
        size.append(n)
    uniq, of, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    hit = (count > 1) | (np.bincount(of, np.concatenate(many), len(uniq)) > 0)
    block, reply = [], []
    for b, part in zip(table.column("block_id").to_pylist(), np.split(hit[of], np.cumsum(size)[:-1])):
        if part.any():
            block.append(b)
            reply.append(np.packbits(part).tobytes())
    return _reply(table.column("bucket")[0].as_py(), block, reply)


def _send_strings(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            if not row["seen"]:
                continue
            b = Block(row, width, buckets)
            bucket, payload, owner = [], [], b.ids[b.doc].tolist()
            for k, strings, have in b.strings(b.flagged(row["seen"])):
                least, most = [min(map(owner.__getitem__, h)) for h in have], [max(map(owner.__getitem__, h)) for h in have]
                bucket.append(k)
                payload.append(_pack(np.array([len(s) for s in strings], np.uint16), np.array(least, np.int64), (np.array(most) > np.array(least)).astype(np.uint8), b"".join(strings)))
            yield _message(bucket, [row["block_id"]] * len(bucket), payload)

    return run


def _smallest_owner(width: int):
    """Per block and string: runs of passages (their ends) with the smallest owner of each, or no run if no document of the block loses anything."""

    def run(table: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        owner: list[int] = []
        sent = []
        for p in table.column("payload"):
            lens, least, many, text = _unpack(p.as_py(), "u2", "i8", "u1", None)
            ends, own = np.cumsum(lens, dtype=np.int64).tolist(), []
            at = 0
            for e, d in zip(ends, least.tolist()):
                s = text[at:e]
                at = e
                k = place.setdefault(s, len(owner))
                if k == len(owner):
                    owner.append(d)
                elif d < owner[k]:
                    owner[k] = d
                own.append(k)
            sent.append((own, least.tolist(), many.tolist()))
        best, first, touched = earliest(list(place), np.array(owner, np.int64), width)
        plain = {}
        for k in touched:
            part = best[first[k] : first[k + 1]]
            cut = np.flatnonzero(part[1:] != part[:-1]) + 1
            plain[k] = (np.append(cut, len(part)).tolist(), part[np.append(cut - 1, len(part) - 1)].tolist())
        block, reply = [], []
        for b, (own, least, many) in zip(table.column("block_id").to_pylist(), sent):
            count, ends, value = [], [], []
            for k, d, m in zip(own, least, many):
                if k in plain:
                    count.append(len(plain[k][0]))
                    ends += plain[k][0]
                    value += plain[k][1]
                elif m or owner[k] < d:
                    count.append(1)
                    ends.append(int(first[k + 1] - first[k]))
                    value.append(owner[k])
                else:
                    count.append(0)
            if ends:
                block.append(b)
                reply.append(_pack(np.array(count, np.uint16), np.array(ends, np.uint16), np.array(value, np.int64)))
        return _reply(table.column("bucket")[0].as_py(), block, reply)

    return run


def _cut(width: int, buckets: int, contents: bool):
    import hashlib

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = Block(row, width, buckets)
            starts = np.cumsum(b.lens) - b.lens
            gone: list[list[tuple[int, int]]] = [[] for _ in b.ids]
            for i in b.copies:
                if b.lens[i] >= width:
                    gone[i].append((0, int(b.lens[i])))
            answer = {r["bucket"]: r["reply"] for r in row["found"] or ()}
            doc, owner, where = b.doc.tolist(), b.ids[b.doc].tolist(), (b.first - starts[b.doc]).tolist()
            for k, _, have in b.strings(b.flagged(row["seen"] or [])) if answer else ():
                if k not in answer:
                    continue
                count, ends, value = (x.tolist() for x in _unpack(answer[k], "u2", "u2", "i8"))
                at = 0
                for n, h in zip(count, have):
                    lo = 0
                    for end, v in zip(ends[at : at + n], value[at : at + n]):
                        for r in h:
                            if v < owner[r]:
                                gone[doc[r]].append((where[r] + lo, where[r] + end - 1 + width))
                        lo = end
                    at += n
            out = {"doc_id": [], "n_bytes": [], "n_removed": [], "spans": [], "kept_sha256": [], "kept": []}
            for i, (s, n) in enumerate(zip(starts.tolist(), b.lens.tolist())):
                spans: list[list[int]] = []
                for lo, hi in sorted(gone[i]):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(hi, spans[-1][1])
                    else:
                        spans.append([lo, hi])
                t, at, kept = b.text[s : s + n], 0, []
                for lo, hi in spans:
                    kept.append(t[at:lo])
                    at = hi
                left = b"".join([*kept, t[at:]])
                for name, v in (("doc_id", row["ids"][i]), ("n_bytes", n), ("n_removed", n - len(left)), ("spans", [{"start": lo, "end": hi} for lo, hi in spans]), ("kept_sha256", hashlib.sha256(left).hexdigest()), ("kept", left)):
                    out[name].append(v)
            cols = [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_bytes"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["spans"], span), pa.array(out["kept_sha256"], pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(out["kept"], pa.binary())] * contents, names=list(out)[: 5 + contents])

    return run
