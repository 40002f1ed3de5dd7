"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes FEATURES, measured on the whole text. The model is a lookup table per feature and per chosen pair
of features. Training cycles through the features; at each, a shallow tree is grown on the feature's histogram of
gradients and added, scaled, to the feature's table. Then pairs are ranked by how much a 2 x 2 split of their
residuals gains, and the best are boosted in the same way on coarser grids. A score is the logistic of the sum of
looked-up values: one vectorised addition per table.

Training reads at most ``max_rows`` labelled rows, those with the smallest hash of their key; only their features
reach the driver. Every row is scored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, prepare, private, remainder, replaced, schema_text, text_or_empty

MAX_ROWS, ROWS_A_KEY, FOLDS, THRESHOLD = 20_000, 4, 5, 0.3
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS, LEAVES, RATE = 32, 8, 150, 60, 8, 4, 0.12
FEATURES = (
    "log_chars", "log_words", "word_chars", "distinct_words", "upper", "digit", "punctuation", "symbol", "bar", "bang",
    "line_words", "repeated_lines", "sentence_words", "short_words", "long_words", "repeated_pairs", "top_word", "ends_marked",
)

_UPPER, _LOWER, _DIGIT, _STOP, _SYMBOL = 1, 2, 3, 4, 5
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _UPPER, _LOWER, _DIGIT
for _c in b".,;:?'\"()-!":
    _CLASS[_c] = _STOP
for _c in b"#$%&*+/<=>@[\\]^_`{|}~":
    _CLASS[_c] = _SYMBOL


def measure(text: str) -> list[float]:
    """FEATURES of one text; ratios of an empty text are 0."""
    raw = text.encode()
    words = raw.lower().split()
    n, w = max(1, len(raw)), max(1, len(words))
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=6)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    distinct = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    pairs = set(zip(words, words[1:], strict=False))
    letters = max(1, int(kinds[_UPPER] + kinds[_LOWER]))
    marked = sum(x[-1:] in b"!*$%&#" for x in words)
    return [
        float(np.log1p(len(raw))), float(np.log1p(len(words))), float(lengths.mean()) if len(words) else 0.0, len(distinct) / w, float(kinds[_UPPER]) / letters,
        float(kinds[_DIGIT]) / n, float(kinds[_STOP]) / n, float(kinds[_SYMBOL]) / n, raw.count(b"|") / w, raw.count(b"!") / w,
        len(words) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), len(words) / max(1, raw.count(b".")), float((lengths <= 3).sum()) / w, float((lengths >= 12).sum()) / w,
        1 - len(pairs) / max(1, len(words) - 1) if len(words) > 1 else 0.0, max(distinct.values(), default=0) / w, marked / w,
    ]


@dataclass
class Model:
    """Cuts per feature, tables per feature and per pair, and the intercept."""

    cuts: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features: bins looked up and added."""
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[k], x[:, k], "right")]
        for (i, j), table in self.pairs.items():
            total += table[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _leaf(g, h):
    return -g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values by bin of a tree with up to ``leaves`` leaves, grown best split first on sums of gradients."""
    gain = lambda a, b: a * a / (b + 1.0)
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-6, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            lg, lh = cg[at] - cg[a], ch[at] - ch[a]
            rg, rh = cg[b] - cg[at], ch[b] - ch[at]
            won = gain(lg, lh) + gain(rg, rh) - gain(cg[b] - cg[a], ch[b] - ch[a])
            won[(lh < 2) | (rh < 2)] = 0
            k = int(won.argmax())
            if won[k] > best[0]:
                best = (won[k], p, at[k])
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(cg[b] - cg[a], ch[b] - ch[a])
    return out


def _pair_gain(g: np.ndarray, h: np.ndarray) -> float:
    """The best gain of cutting a grid of gradients once in each direction."""
    gain = lambda a, b: a * a / (b + 1.0)
    cg, ch = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (g, h))
    a, b = np.arange(1, len(g)), np.arange(1, len(g))
    tg, th = cg[-1, -1], ch[-1, -1]
    total = 0.0
    q = lambda c: (c[a][:, b], c[a][:, -1:] - c[a][:, b], c[-1:, b] - c[a][:, b], c[-1, -1] - c[a][:, -1:] - c[-1:, b] + c[a][:, b])
    for x, y in zip(q(cg), q(ch), strict=True):
        total = total + gain(x, y)
    return float((total - gain(tg, th)).max())


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS) -> Model:
    """Train on features ``x`` and labels ``y``; without labels, or with one class only, the model is a constant."""
    n = x.shape[1] if x.ndim == 2 else len(FEATURES)
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model([np.zeros(0)] * n, [np.zeros(0)] * n, float(np.log(share / (1 - share))), [np.zeros(1)] * n)
    if len(y) < 2 or y.min() == y.max():
        return model
    quantiles = lambda col, k: np.unique(np.quantile(col, np.arange(1, k) / k))
    model.cuts = [quantiles(x[:, k], BINS) for k in range(n)]
    model.coarse = [quantiles(x[:, k], PAIR_BINS) for k in range(n)]
    fine = [np.searchsorted(model.cuts[k], x[:, k], "right") for k in range(n)]
    coarse = [np.searchsorted(model.coarse[k], x[:, k], "right") for k in range(n)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.base)

    def gradients():
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for k in range(n):
            g, h = gradients()
            size = len(model.tables[k])
            step = RATE * _tree(np.bincount(fine[k], g, size), np.bincount(fine[k], h, size), LEAVES)
            model.tables[k] += step
            total += step[fine[k]]
    g, h = gradients()
    grid = lambda i, j, v: np.bincount(coarse[i] * PAIR_BINS + coarse[j], v, PAIR_BINS * PAIR_BINS).reshape(PAIR_BINS, PAIR_BINS)
    ranked = sorted(combinations(range(n), 2), key=lambda p: -_pair_gain(grid(*p, g), grid(*p, h)))[:pairs]
    model.pairs = {p: np.zeros((PAIR_BINS, PAIR_BINS)) for p in ranked}
    for _ in range(pair_rounds):
        for i, j in ranked:
            g, h = gradients()
            gg, hh = grid(i, j, g), grid(i, j, h)
            # A tree of depth two: rows in two parts by the best tree on their sums, each part split by columns.
            rows = _tree(gg.sum(1), hh.sum(1), 2)
            step = np.zeros_like(gg)
            for value in np.unique(rows):
                part = rows == value
                step[part] = RATE * _tree(gg[part].sum(0), hh[part].sum(0), 2)
            model.pairs[i, j] += step
            total += step[coarse[i], coarse[j]]
    return model


def measured(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the features (array of double) of every row."""

    def run(batches):
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "features"])

    return df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(run, "doc_id long, features array<double>")


def labelled(labels: DataFrame, label: str, key: str) -> DataFrame:
    """(_k, _label) outside the held-out fold: a key with several labels has the largest; null keys and others than 0, 1 go."""
    own = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("_k")).agg(F.max(label).cast("int").alias("_label"))
    return own.filter(remainder("_k", FOLDS) != 0)


def few_a_key(rows: DataFrame, most: int = ROWS_A_KEY) -> DataFrame:
    """``rows`` (_k, text, ...) with _n: the first ``most`` of each key by the texts' hashes, numbered from 1.

    The limit holds in each task before rows shuffle, so a key with many rows doesn't gather them.
    """
    order = Window.partitionBy("_k").orderBy(F.xxhash64("text"), "text")
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= most)


def training_rows(df: DataFrame, labels: DataFrame, label: str, key: str, text: str, max_rows: int) -> DataFrame:
    """(doc_id, text, _label, _k, _n) of at most ``max_rows`` labelled keys, by a hash of the key; ROWS_A_KEY rows of a key at most."""
    order = [F.xxhash64("_k"), "_k"]
    rows = df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    some = labelled(labels, label, key).orderBy(*order).limit(max_rows)
    return few_a_key(rows.join(F.broadcast(some), F.col("doc_id") == F.col("_k"))).select("doc_id", "text", "_label", "_k", "_n")


def train(df: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold, those with the smallest hash of their key.

    A key with several labels has the largest; null keys and labels other than 0 and 1 are left out. Of rows that repeat a
    key ROWS_A_KEY count, so that no key can fill the bound. Only features reach the driver.
    """
    rows = training_rows(df, labels, label, key, text, max_rows)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([measure(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))], ["doc_id", "label", "features"])

    # Repeated keys can make more rows than keys were chosen: the first ones are taken, in an order that rows alone decide.
    found = rows.select("doc_id", "text", "_label").mapInArrow(run, "doc_id long, label int, features array<double>")
    got = found.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(max_rows).toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["features"].to_list(), float).reshape(-1, len(FEATURES))
    return fit(x, got["label"].to_numpy(float))


def scored(df: DataFrame, model: Model, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``df`` and held_out, score, predicted; columns of these names are replaced.

    Null and empty texts are scored like any other. Rows that repeat are scored alike; a null key has the fold of
    the empty text. An empty table gives an empty result.
    """
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    df = replaced(df, ("held_out", "score", "predicted"))
    names = df.columns
    own, *short = private([], "_text", *(f"_c{k}" for k in range(len(names))))

    @lean("quality")
    def run(batches):
        for batch in batches:
            x = np.array([measure(t.as_py()) for t in batch.column(len(names))], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shared.value.score(x))], [*short, "score"])

    # mapInArrow takes no names with dots: columns go by number.
    plain = df.select("*", text_or_empty(text).alias(own)).toDF(*short, own)
    out = plain.mapInArrow(run, schema_text(plain.drop(own)) + ", score double").toDF(*names, "score")
    return out.withColumns({"held_out": remainder(key, FOLDS) == 0, "predicted": (F.col("score") >= threshold).cast("int")})
