"""Benchmark decontamination by a BM25 inverted index of the test items with block-max WAND."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import bounded_batches, whole_text

_MARKS = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalnum()})
#: Items and characters that one index holds at most; a larger benchmark is asked in so many passes. Items under SHORT characters share one.
SLICE, SLICE_CHARS, SHORT = 20_000, 16 << 20, 1000


def words(text: str) -> list[str]:
    return text.lower().translate(_MARKS).split()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words up to and with its first question mark, and those after it; without one (or with nothing on a side), all its words and none."""
    head, _, tail = text.partition("?")
    q, a = words(head), words(tail)
    return (q, a) if q and a else (q + a, [])


def shingles(w: list[str], width: int = 5) -> set[tuple[str, ...]]:
    """All runs of ``width`` words; fewer words are one shingle, none is none."""
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


class Corpus:
    """BM25 statistics over all items."""

    def __init__(self) -> None:
        self.n, self.length, self.df = 0, 0, Counter()

    def add(self, item: list[str]) -> None:
        self.n += 1
        self.length += len(item)
        self.df.update(set(item))


class Index:
    """Postings by term with block maxima; impacts are BM25 weights over the item's own score, so an item scores its own text 1."""

    def __init__(self, items: list[tuple], corpus: Corpus, k1: float = 1.2, b: float = 0.75, block: int = 4, common: float = 0.05):
        self.ids, self.parts, self.block = [], [], block
        postings: dict[str, list[tuple[int, float]]] = {}
        self.longest = 1
        for item_id, text in items:
            w = words(text)
            if not w:
                continue
            i = len(self.ids)
            self.ids.append(item_id)
            self.parts.append(tuple(shingles(p) for p in question_and_answer(text)))
            self.longest = max(self.longest, len(w))
            norm = k1 * (1 - b + b * len(w) * corpus.n / corpus.length)
            raw = {t: math.log(1 + (corpus.n - corpus.df[t] + 0.5) / (corpus.df[t] + 0.5)) * c * (k1 + 1) / (c + norm) for t, c in Counter(w).items()}
            total = sum(raw.values())
            for t, v in raw.items():
                postings.setdefault(t, []).append((i, v / total))
        self.term = {t: k for k, t in enumerate(postings)}
        self.ords = [[i for i, _ in p] for p in postings.values()]
        self.impacts = [[v for _, v in p] for p in postings.values()]
        self.most = [max(v) for v in self.impacts]
        self.blocks: list[dict[int, float]] = []
        for o, v in zip(self.ords, self.impacts):
            best: dict[int, float] = {}
            for i, x in zip(o, v):
                best[i // block] = max(x, best.get(i // block, 0.0))
            self.blocks.append(best)
        n_blocks = -(-len(self.ids) // block)
        # block maxima of the terms in many blocks as rows, those of the others as postings
        dense = [k for k, m in enumerate(self.blocks) if len(m) > max(4, common * n_blocks)]
        self.dense_row = np.full(len(self.term), -1, np.int64)
        self.dense_row[dense] = np.arange(len(dense))
        self.dense = np.zeros((len(dense), n_blocks), np.float32)
        for r, k in enumerate(dense):
            self.dense[r, list(self.blocks[k])] = list(self.blocks[k].values())
        size = [0 if self.dense_row[k] >= 0 else len(m) for k, m in enumerate(self.blocks)]
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.in_block = np.array([j for k, m in enumerate(self.blocks) if self.dense_row[k] < 0 for j in m], np.int64)
        self.in_value = np.array([v for k, m in enumerate(self.blocks) if self.dense_row[k] < 0 for v in m.values()], np.float32)

    def bounds(self, passage: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Upper bound of each passage's score for each block of items, from distinct (passage, term)."""
        row = self.dense_row[term]
        hit = np.zeros((n, len(self.dense)), np.float32)
        hit[passage[row >= 0], row[row >= 0]] = 1
        out = hit @ self.dense if len(self.dense) else np.zeros((n, self.dense.shape[1]), np.float32)
        p, t = passage[row < 0], term[row < 0]
        size = self.start[t + 1] - self.start[t]
        at = np.repeat(self.start[t] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        np.add.at(out, (np.repeat(p, size), self.in_block[at]), self.in_value[at])
        return out

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose score for these terms reaches the threshold."""
        out, end = [], len(self.ids)
        cursor = [[self.ords[t][0], t, 0] for t in terms]  # next item, term, place in its postings

        def go(c: list, to: int) -> None:
            o = self.ords[c[1]]
            c[2] = bisect_left(o, to, c[2])
            c[0] = o[c[2]] if c[2] < len(o) else end

        while True:
            cursor.sort()
            total, pivot = 0.0, -1
            for k, c in enumerate(cursor):
                if c[0] == end:
                    break
                total += self.most[c[1]]
                if total >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = cursor[pivot][0]
            while pivot + 1 < len(cursor) and cursor[pivot + 1][0] == item:
                pivot += 1
            here = item // self.block
            if sum(self.blocks[c[1]].get(here, 0.0) for c in cursor[: pivot + 1]) < threshold - 1e-9:
                to = (here + 1) * self.block
                if pivot + 1 < len(cursor):
                    to = min(to, cursor[pivot + 1][0])
                for c in cursor[: pivot + 1]:
                    if c[0] < max(to, item + 1):
                        go(c, max(to, item + 1))
            elif cursor[0][0] == item:
                score = sum(self.impacts[c[1]][c[2]] for c in cursor[: pivot + 1])
                if score >= threshold - 1e-9:
                    out.append((item, score))
                for c in cursor[: pivot + 1]:
                    go(c, item + 1)
            else:
                for c in cursor[:pivot]:
                    if c[0] < item:
                        go(c, item)

    def retrieve(self, text_words: list[str], threshold: float, step: int) -> dict[int, float]:
        """Best score of each item that some passage of two steps of ``step`` words reaches."""
        known = np.array([self.term.get(w, -1) for w in text_words], np.int64)
        at = np.flatnonzero(known >= 0)
        if not len(at) or not self.ids:
            return {}
        n = len(text_words) // step + 1
        key = np.unique((at // step) * len(self.term) + known[at])
        key = np.unique(np.concatenate([key, key[key >= len(self.term)] - len(self.term)]))  # passage p has steps p and p + 1
        best: dict[int, float] = {}
        for lo in range(0, n, 4096):
            own = key[np.searchsorted(key, lo * len(self.term)) : np.searchsorted(key, (lo + 4096) * len(self.term))]
            passage, term = own // len(self.term) - lo, own % len(self.term)
            for p in np.flatnonzero(self.bounds(passage, term, min(4096, n - lo)).max(1) >= threshold - 1e-4):
                for item, score in self.search(term[passage == p].tolist(), threshold):
                    best[item] = max(score, best.get(item, 0.0))
        return best


def _slices(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[list[tuple]]:
    """The items by length, in parts of ``size`` items and ``SLICE_CHARS`` characters at most (or one longer item), in which no item is over
    four times as long as the shortest, short ones aside; so a long item makes passages long in its own part only."""
    text = whole_text(text_col)
    rows = benchmark.select(F.col(id_col), text, F.length(text).alias("n")).orderBy("n", id_col, text)
    part: list[tuple] = []
    chars = 0
    for r in rows.toLocalIterator():
        if part and (len(part) == size or chars + r[2] > SLICE_CHARS or r[2] > 4 * max(SHORT, len(part[0][1]))):
            yield part
            part, chars = [], 0
        part.append((r[0], r[1]))
        chars += r[2]
    if part:
        yield part


def _indexes(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, size: int) -> Iterator:
    """An index per part of the items, sent once to each executor; BM25 counts are of all items."""
    corpus = Corpus()
    for part in _slices(benchmark, id_col, text_col, size):
        for _, t in part:
            if w := words(t):
                corpus.add(w)
    for part in _slices(benchmark, id_col, text_col, size):
        yield docs.sparkSession.sparkContext.broadcast(Index(part, corpus))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = 0.6, overlap: float = 0.8, size: int = SLICE) -> DataFrame:
    """Pairs (doc_id, item_id, score, question_overlap, answer_overlap) of documents and the items they hold.

    Every passage of every whole text is a query: windows of two steps, a step being the longest item's words (64 at least),
    so any item lies within one. An item is retrieved if its BM25 score for the passage's distinct words reaches ``threshold`` of its score
    for its own; it counts if ``overlap`` of the five-word shingles of its question and as many of its answer stand in the text. An item
    that doesn't give both is one question, asked for as a whole; its answer_overlap is 1.

    The benchmark is read in parts by length, ``size`` items at most and bounded in bytes; each is one index, broadcast to the executors, and one pass
    over the texts, while BM25 counts are of all items. Null and empty texts hold nothing; items without words are held by none;
    ids of either table may be of any type, null and repeated ones come back as they are, a pair for each row; no documents or no items give no
    rows. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    kind, item = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id_col].dataType
    schema = f"doc_id {kind}, item_id {item.simpleString()}, score double, question_overlap double, answer_overlap double"
    texts = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    out = None
    for index in _indexes(docs, benchmark, item_id_col, item_text_col, size):
        found = texts.mapInArrow(_pass(index, threshold, overlap, to_arrow_type(item)), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def held_items(index: Index, text: str, threshold: float, overlap: float) -> list[tuple[int, float, float, float]]:
    """(place in the index, score, question overlap, answer overlap) of the items that a text holds."""
    w = words(text)
    found = index.retrieve(w, threshold, max(64, index.longest))
    if not found:
        return []
    have = {width: {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} for width in {len(s) for j in found for part in index.parts[j] for s in part}}
    out = []
    for j, score in sorted(found.items()):
        q, a = (sum(x in have[len(x)] for x in part) / len(part) if part else 1.0 for part in index.parts[j])
        if min(q, a) >= overlap - 1e-9:
            out.append((j, score, q, a))
    return out


def _pass(shared, threshold: float, overlap: float, item_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            rows = [(i, *hit) for i, t in enumerate(b.column(1)) for hit in held_items(index, t.as_py(), threshold, overlap)]
            row, item, score, left, right = zip(*rows) if rows else ((),) * 5
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array([index.ids[j] for j in item], item_kind), *(pa.array(x, pa.float64()) for x in (score, left, right))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def flag(shared, threshold: float, overlap: float):
    """A column function text -> whether it holds an item of the index."""

    @F.arrow_udf("boolean")
    def held(texts: pa.Array) -> pa.Array:
        return pa.array([bool(held_items(shared.value, t.as_py(), threshold, overlap)) for t in texts], pa.bool_())

    return lambda name: held(whole_text(name))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = 0.6, overlap: float = 0.8, size: int = SLICE) -> DataFrame:
    """The rows of ``docs``, all their columns, whose text holds no item; see ``contaminated``."""
    bounded_batches(docs.sparkSession)
    out = docs
    for index in _indexes(docs, benchmark, item_id_col, item_text_col, size):
        out = out.where(~flag(index, threshold, overlap)(text_col))
    return out
