"""Quality classifier: a generalised additive model with pairwise interactions, boosted into lookup tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, whole_text

FEATURES = [
    "log_bytes", "log_words", "mean_word", "longest_word", "upper_share", "digit_share", "space_share", "stop_share", "comma_share", "bang_share",
    "mark_share", "bar_share", "wide_share", "entropy", "distinct_words", "top_word", "echo_words", "distinct_pairs", "short_words", "capital_words",
    "log_lines", "mean_line", "distinct_lines", "ended_lines",
]

_CLASS = np.zeros((256, 8), np.float64)
for _k, _chars in enumerate((bytes(range(65, 91)), bytes(range(48, 58)), b" \t\n\x0b\x0c\r", b".?", b",;:", b"!", b"#$%&*@^~<>=+/\\_`{}[]", b"|")):
    _CLASS[list(_chars), _k] = 1


def features(text: str) -> list[float]:
    """The features of a whole text; an empty one has zeros throughout."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    n, m = len(raw), len(words)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count @ _CLASS / n
    p = count[count > 0] / n
    pairs = list(zip(words, words[1:]))
    lines = [x for x in (x.strip() for x in raw.split(b"\n")) if x]
    length = np.fromiter(map(len, words), np.int64, m)
    return [
        np.log1p(n), np.log1p(m), length.mean(), float(length.max()), share[0], share[1], share[2], share[3], share[4], share[5],
        share[6], share[7], count[128:].sum() / n, float(-(p * np.log2(p)).sum()), len(set(words)) / m, Counter(words).most_common(1)[0][1] / m, sum(a == b for a, b in pairs) / m,
        len(set(pairs)) / max(1, len(pairs)), float((length <= 3).mean()), sum(w[:1].isupper() for w in raw.split()) / m,
        np.log1p(len(lines)), n / len(lines), len(set(lines)) / len(lines), sum(x[-1:] in b".!?\"'" for x in lines) / len(lines),
    ]


@dataclass
class AdditiveModel:
    """log-odds = base + one table per feature + one table per pair of features, each looked up by bin."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(x), 0), int)

    def logit(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for j, t in enumerate(self.tables):
            out += t[bins[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[bins[:, i], bins[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(self.bins(x)), -30, 30)))


def _cut(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, int]:
    """Best split of ordered bins by Newton gain: (gain over no split, bins to the left)."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    gain = cg**2 / (ch + penalty) + (cg[-1] - cg) ** 2 / (ch[-1] - ch + penalty)
    k = int(np.argmax(gain[:-1])) if len(g) > 1 else 0
    return float(gain[k] - cg[-1] ** 2 / (ch[-1] + penalty)), k + 1


def _shallow(g: np.ndarray, h: np.ndarray, penalty: float, depth: int = 2) -> np.ndarray:
    """Values of a shallow tree over ordered bins."""
    if depth and len(g) > 1 and h.sum() > 1e-9:
        gain, k = _cut(g, h, penalty)
        if gain > 1e-9:
            return np.concatenate([_shallow(g[:k], h[:k], penalty, depth - 1), _shallow(g[k:], h[k:], penalty, depth - 1)])
    return np.full(len(g), -g.sum() / (h.sum() + penalty))


def _shallow_pair(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """A tree that cuts one of two features, then the other on each side: (values, gain)."""
    best, values = -1.0, np.zeros_like(g)
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        for k in range(1, a.shape[0]):
            total, out = 0.0, np.empty_like(a)
            for part in (slice(0, k), slice(k, None)):
                pg, ph = a[part].sum(0), b[part].sum(0)
                gain, _ = _cut(pg, ph, penalty)
                total += gain + pg.sum() ** 2 / (ph.sum() + penalty)
                out[part] = _shallow(pg, ph, penalty, 1)[None, :]
            if total > best:
                best, values = total, out if axis == 0 else out.T
    return values, best - g.sum() ** 2 / (h.sum() + penalty)


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, pair_bins: int = 8, pairs: int = 6, rounds: int = 120, pair_rounds: int = 40, rate: float = 0.15, penalty: float = 2.0) -> AdditiveModel:
    """Boosts shallow trees over one feature at a time, in turns, then over the pairs that promise most.

    Each tree sees one feature (or pair) only, so their sum folds into one table for each. With labels of
    one kind, or none, the model is their smoothed share (a half without labels).
    """
    model = AdditiveModel(base=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    if len(y) == 0 or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    b = model.bins(x)
    f = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            g, h = slope()
            step = rate * _shallow(np.bincount(b[:, j], g, len(t)), np.bincount(b[:, j], h, len(t)), penalty)
            t += step
            f += step[b[:, j]]
    coarse = [np.minimum(np.arange(len(t)) * pair_bins // len(t), pair_bins - 1) for t in model.tables]
    cb = np.stack([c[b[:, j]] for j, c in enumerate(coarse)], 1)

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(cb[:, i] * pair_bins + cb[:, j], v, pair_bins**2).reshape(pair_bins, pair_bins)

    g, h = slope()
    gains = sorted(((-_shallow_pair(grid(i, j, g), grid(i, j, h), penalty)[1], i, j) for i in range(x.shape[1]) for j in range(i)), key=lambda v: v)
    model.pairs = [(i, j) for _, i, j in gains[:pairs]]
    small = [np.zeros((pair_bins, pair_bins)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, small):
            g, h = slope()
            step = rate * _shallow_pair(grid(i, j, g), grid(i, j, h), penalty)[0]
            t += step
            f += step[cb[:, i], cb[:, j]]
    model.pair_tables = [t[coarse[i]][:, coarse[j]] for (i, j), t in zip(model.pairs, small)]
    return model


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the features of each row's whole text."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(1)], np.float64).reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[:, j]) for j in range(x.shape[1]))], names=["doc_id", *FEATURES])

    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


def _training_labels(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    own = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    return own.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(most)


def training_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = 20_000) -> DataFrame:
    """The ids that ``learn`` takes, ``most`` at most."""
    return _training_labels(labels, id_col, label_col, most).select("doc_id").distinct()


def learn(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = 20_000, **options) -> AdditiveModel:
    """Fits on labelled rows that are not held out: at most ``most`` of them, the first by a hash of the id.

    Labels other than 0 and 1 are passed over; a document labelled twice counts twice.
    """
    own = _training_labels(labels, id_col, label_col, most)
    rows = table.join(own, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "_y", *FEATURES).limit(most).select("_y", *FEATURES).toPandas()
    return fit(rows[FEATURES].to_numpy(np.float64).reshape(-1, len(FEATURES)), rows["_y"].to_numpy(np.float64), **options)


def score_table(table: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for rows with features, by additions of looked-up bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(1, b.num_columns)], 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = table.schema["doc_id"].dataType.simpleString()
    out = table.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, most: int = 20_000) -> DataFrame:
    """Learns from ``labels`` and scores every row's whole text: doc_id, held_out, score, predicted.

    The score is the likelihood of label 1; only the text goes into it. Null and empty texts have zero features and
    get the score that those lead to. A null doc_id is scored like any other (and held out). Repeated rows are scored as
    often as they come; no rows give no rows; without labels every score is a half. Other columns are ignored.
    """
    table = materialize(feature_table(docs, id_col, text_col), "features")
    return score_table(table, learn(table, labels, id_col, label_col, most), threshold)


def scorer(model: AdditiveModel):
    """A column function text -> score, for use where the rows must keep their other columns."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array([features(t.as_py()) for t in texts], np.float64).reshape(len(texts), len(FEATURES))))

    return lambda name: score(whole_text(name))
