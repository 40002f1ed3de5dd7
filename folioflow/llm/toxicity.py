"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A token's input joins a word embedding (for words of the training sample) and the mean embedding of its hashed
character n-grams (their sum over the root of their number). Both directions of a GRU read windows of WINDOW tokens; attention weighs the states, and a linear
layer gives the window's logit. Windows overlap: each starts STRIDE tokens after the one before, the last ends with
the text. A text's score is the calibrated logistic of its largest window logit.

Training is multiple-instance: a toxic text's windows above the others count as toxic, the rest of it as nothing;
clean texts give clean windows; all windows of a text are looked at. It reads at most ``max_rows`` toxic and twice as
many clean labelled texts, by hash of the key, and at most ``max_chars`` characters of them; the calibration weighs them
so that each class counts with its share of all training labels.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, prepare, private, remainder, replaced, schema_text, text_or_empty
from .quality import FOLDS, few_a_key, labelled

MAX_ROWS, CLEAN_SHARE, THRESHOLD = 2_000, 2, 0.5
WINDOW, STRIDE, HIDDEN, WIDTH = 32, 24, 8, 8
GRAMS, BUCKETS, VOCABULARY, LEAST_ROWS = (3, 4, 5), 1 << 15, 30_000, 3
EPOCHS, BATCH, RATE, CLEAN_WINDOWS, MAX_CHARS = 4, 256, 0.05, 3, 40_000_000
TABLE_ROWS, SCORE_WINDOWS, LEAST_APART = 120_000, 4_096, 500
_STRIP = b".,;:!?\"'()[]{}*%$&#<>|-_"


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of its word) of every character n-gram of GRAMS of the words, each between marks."""
    joined = b"".join(b"\x02" + w + b"\x03" for w in words)
    data = np.frombuffer(joined, np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    buckets, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, n, np.uint32)
        for k in range(n):
            h = h * np.uint32(0x01000193) ^ data[k : len(data) - n + 1 + k]
        h ^= h >> np.uint32(15)
        h = (h * np.uint32(0x2C1B3C6D)) >> np.uint32(17)
        own = owner[: len(h)]
        inside = own == owner[n - 1 :]
        buckets.append(h[inside].astype(np.int64) % BUCKETS)
        owners.append(own[inside])
    return np.concatenate(buckets), np.concatenate(owners)


def windows(count: int, window: int = WINDOW, stride: int = STRIDE) -> np.ndarray:
    """Starts of the windows over ``count`` tokens: all of them, overlapping, the last at the end."""
    if count <= window:
        return np.zeros(1, np.int64)
    starts = np.arange(0, count - window + 1, stride)
    return starts if starts[-1] == count - window else np.append(starts, count - window)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, forward pass, gradients. Row 0 of every token table is padding: it leaves the state as it is."""

    def __init__(self, vocabulary: dict[bytes, int], seed: int = 0):
        r = np.random.default_rng(seed)
        f = lambda *shape: (r.normal(size=shape) * 0.2).astype(np.float32)
        self.vocabulary, self.version = vocabulary, uuid.uuid4().hex
        self.p = {"word": f(len(vocabulary) + 1, WIDTH) * 0.1, "gram": f(BUCKETS, WIDTH) * 0.1, "in": f(2 * WIDTH, 6 * HIDDEN), "bias": np.zeros(6 * HIDDEN, np.float32), "rec": f(2, HIDDEN, 3 * HIDDEN), "att": f(2 * HIDDEN), "out": f(2 * HIDDEN), "b": np.zeros(1, np.float32)}
        self.p["word"][0] = 0
        self.slope, self.shift = 1.0, 0.0

    def known(self, word: bytes) -> int:
        return self.vocabulary.get(word.strip(_STRIP), 0)

    def inputs(self, words: list[bytes]):
        """Input vectors of the words, and what the gradient needs."""
        w = np.fromiter(map(self.known, words), np.int64, len(words))
        bucket, owner = gram_buckets(words)
        n = np.sqrt(np.maximum(np.bincount(owner, minlength=len(words)), 1)).astype(np.float32)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(words)))
        total = np.concatenate([np.zeros((1, WIDTH)), np.cumsum(self.p["gram"][bucket[order]], 0, dtype=np.float64)])
        grams = (total[ends] - total[ends - np.bincount(owner, minlength=len(words))]) / n[:, None]
        return np.concatenate([self.p["word"][w], grams.astype(np.float32)], 1), (w, bucket, owner, n)

    def projected(self, x: np.ndarray) -> np.ndarray:
        return x @ self.p["in"] + self.p["bias"]

    @staticmethod
    def padding() -> np.ndarray:
        row = np.zeros((1, 6 * HIDDEN), np.float32)
        row[0, :HIDDEN] = row[0, 3 * HIDDEN : 4 * HIDDEN] = 30
        return row

    def run(self, table: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows of token rows (0: padding); with ``keep``, all that the gradient needs."""
        n, steps = ids.shape
        states = np.empty((2, steps, n, HIDDEN), np.float32)
        kept = []
        for d in range(2):
            h, rec = np.zeros((n, HIDDEN), np.float32), self.p["rec"][d]
            half = table[:, 3 * HIDDEN * d : 3 * HIDDEN * (d + 1)] if keep else np.ascontiguousarray(table[:, 3 * HIDDEN * d : 3 * HIDDEN * (d + 1)])
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, u = half[ids[:, t]], h @ rec
                gate = x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN]
                np.negative(gate, gate)
                np.exp(gate, gate)
                gate += 1
                np.reciprocal(gate, gate)
                z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                if keep:
                    kept.append((d, t, h, z, r, new, u[:, 2 * HIDDEN :]))
                h = new + z * (h - new)
                states[d, t] = h
        e = states[0] @ self.p["att"][:HIDDEN] + states[1] @ self.p["att"][HIDDEN:]
        e[(ids == 0).T] = -1e9
        e -= e.max(0)
        a = np.exp(e)
        a /= a.sum(0)
        value = states[0] @ self.p["out"][:HIDDEN] + states[1] @ self.p["out"][HIDDEN:]
        logits = (a * value).sum(0) + self.p["b"]
        return (logits, (states, a, value, kept)) if keep else logits

    def gradients(self, table, ids, toxic, weight):
        """Mean loss and gradients for the recurrent part, and for the rows of ``table``."""
        logits, (states, a, value, kept) = self.run(table, ids, True)
        p = _sigmoid(logits)
        dl = ((p - toxic) * weight / len(ids)).astype(np.float32)
        mean = logits - self.p["b"]
        dv, de = a * dl, a * (value - mean) * dl
        g = {k: np.zeros_like(self.p[k]) for k in ("rec", "att", "out")} | {"b": np.array([dl.sum()], np.float32)}
        ds = np.empty_like(states)
        for d in range(2):
            part = slice(HIDDEN * d, HIDDEN * (d + 1))
            g["out"][part] = np.einsum("tn,tnh->h", dv, states[d])
            g["att"][part] = np.einsum("tn,tnh->h", de, states[d])
            ds[d] = dv[..., None] * self.p["out"][part] + de[..., None] * self.p["att"][part]
        dtable = np.zeros_like(table)
        dh = [np.zeros((len(ids), HIDDEN), np.float32) for _ in range(2)]
        for d, t, h, z, r, new, un in reversed(kept):
            now = dh[d] + ds[d, t]
            dn = now * (1 - z) * (1 - new * new)
            dz = now * (h - new) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r], 1)
            g["rec"][d] += h.T @ du
            dh[d] = now * z + du @ self.p["rec"][d].T
            np.add.at(dtable, (ids[:, t], slice(3 * HIDDEN * d, 3 * HIDDEN * (d + 1))), np.concatenate([dz, dr, dn], 1))
        dtable[0] = 0
        loss = float((weight * (np.logaddexp(0, logits) - toxic * logits)).mean())
        return loss, g, dtable


class _Steps:
    """Adagrad, on whole arrays or on rows."""

    def __init__(self, rate: float):
        self.rate, self.seen = rate, {}

    def take(self, name: str, value: np.ndarray, gradient: np.ndarray, rows=slice(None)):
        seen = self.seen.setdefault(name, np.full(value.shape, 1e-6, np.float32))
        seen[rows] += gradient * gradient
        value[rows] -= self.rate * gradient / np.sqrt(seen[rows])


def _evidence(counts: np.ndarray, rows: tuple) -> np.ndarray:
    """Log odds in units of their standard error, from the texts of either label that have a feature, within +-10."""
    odds = np.log((counts[1] + 0.5) / (rows[1] + 1)) - np.log((counts[0] + 0.5) / (rows[0] + 1))
    return np.clip(odds / np.sqrt(1 / (counts[0] + 0.5) + 1 / (counts[1] + 0.5)), -10, 10).astype(np.float32)


def _numbered(texts: list[str]):
    """All words of the texts, and each text as numbers of them; word lists are dropped as soon as they are numbered."""
    number: dict[bytes, int] = {}
    ids = []
    for t in texts:
        words = tokens(t)
        ids.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
    return list(number), ids


def _counted(words: list[bytes], ids: list[np.ndarray], toxic: np.ndarray):
    """Texts of either label that have each word (without punctuation around it), and that have each n-gram bucket."""
    stripped: dict[bytes, int] = {}
    plain = np.fromiter((stripped.setdefault(w.strip(_STRIP), len(stripped)) for w in words), np.int64, len(words))
    by_word, by_gram = np.zeros((2, len(stripped))), np.zeros((2, BUCKETS))
    for mine, label in zip(ids, toxic.astype(int), strict=True):
        own = np.unique(mine)
        if len(own):
            by_word[label, np.unique(plain[own])] += 1
            by_gram[label, np.unique(gram_buckets([words[k] for k in own])[0])] += 1
    return list(stripped), by_word, by_gram


def _strongest(net, words: list[bytes], grams: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """The strongest single evidence of each word, by itself or an n-gram of it; one more row for no word."""
    single = np.full(len(words) + 1, -np.inf)
    alone = np.concatenate([[-10], odds])
    for k in range(0, len(words), 20_000):
        part = words[k : k + 20_000]
        bucket, own = gram_buckets(part)
        np.maximum.at(single, own + k, grams[bucket])
        single[k : k + len(part)] = np.maximum(single[k : k + len(part)], alone[[net.known(w) for w in part]])
    return single


def fit(texts: list[str], labels, epochs: int = EPOCHS, seed: int = 0, stands_for: tuple[float, float] = (1.0, 1.0)) -> Network:
    """Train on texts and labels (1: toxic). With one class only, the network scores every text by that class's share.

    A clean and a toxic text stand for so many each in the calibration."""
    toxic = np.asarray(labels, np.float32)
    apart = np.zeros(len(toxic), bool)
    if len(toxic) >= LEAST_APART:  # every fifth text only calibrates
        apart[::5] = True
    aside = ([t for t, x in zip(texts, apart, strict=True) if x], toxic[apart]) if apart.any() else (texts, toxic)
    texts, toxic = [t for t, x in zip(texts, apart, strict=True) if not x], toxic[~apart]
    words, ids = _numbered(texts)
    del texts
    plain, by_word, by_gram = _counted(words, ids, toxic)
    often = np.flatnonzero(by_word.sum(0) >= LEAST_ROWS)
    often = often[np.lexsort((often, -by_word.sum(0)[often]))][:VOCABULARY]
    share = max(1.0, float((1 - toxic).sum())), max(1.0, float(toxic.sum()))
    odds, grams = _evidence(by_word[:, often], share), _evidence(by_gram, share)
    net = Network({plain[k]: n + 1 for n, k in enumerate(often)}, seed)
    del plain, by_word, by_gram
    if not len(toxic) or toxic.min() == toxic.max():
        net.p["out"][:] = 0
        net.slope, net.shift = 0.0, float(np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5)))
        return net
    net.p["word"][1:, 0] = odds / 5
    net.p["gram"][:, 0] = grams / 5
    r, steps = np.random.default_rng(seed), _Steps(RATE)

    def scores(rows):
        out = np.empty(len(rows))
        for k in range(0, len(rows), 1024):
            table, at = _table(net, words, rows[k : k + 1024])
            out[k : k + 1024] = net.run(table, at)
        return out

    starts = [windows(len(mine)) for mine in ids]
    owner = np.repeat(np.arange(len(ids), dtype=np.int32), [len(s) for s in starts])
    rows = np.full((len(owner), WINDOW), -1, np.int32)
    for k, (doc, start) in enumerate(zip(owner.tolist(), np.concatenate(starts).tolist(), strict=True)):
        part = ids[doc][start : start + WINDOW]
        rows[k, : len(part)] = part
    flag = toxic[owner]
    alone = np.bincount(owner, minlength=len(ids))
    # At first a toxic text's windows are ranked by the strongest single word or n-gram, then by the network.
    single = _strongest(net, words, grams, odds)
    for epoch in range(epochs):
        got = scores(rows) if epoch else np.concatenate([single[rows[k : k + 4096]].max(1) for k in range(0, len(rows), 4096)])
        top = np.full(len(ids), -np.inf)
        np.maximum.at(top, owner, got)
        # Of a toxic text count its best window and, later, all above a half; of a clean one its worst and some more.
        use = np.where(flag == 1, got >= np.minimum(top[owner], 0 if epoch else np.inf), (got == top[owner]) | (r.random(len(rows)) * alone[owner] < CLEAN_WINDOWS))
        if not (use & (flag == 1)).any():
            use = np.ones(len(rows), bool)
        order = r.permutation(np.flatnonzero(use))
        share = float(flag[order].mean())
        for k in range(0, len(order), BATCH):
            part = order[k : k + BATCH]
            table, at, back = _table(net, words, rows[part], True)
            weight = np.where(flag[part] == 1, 0.5 / max(share, 0.05), 0.5 / max(1 - share, 0.05)).astype(np.float32)
            _, g, dtable = net.gradients(table, at, flag[part], weight)
            x, (w, bucket, gowner, n) = back
            dtable = dtable[1:]
            dx = dtable @ net.p["in"].T
            for name, value in (*g.items(), ("in", x.T @ dtable), ("bias", dtable.sum(0))):
                steps.take(name, net.p[name], value)
            gw, iw = np.zeros((len(net.p["word"]), WIDTH), np.float32), np.unique(w[w > 0])
            np.add.at(gw, w, dx[:, :WIDTH])
            steps.take("word", net.p["word"], gw[iw], iw)
            gg, ig = np.zeros((BUCKETS, WIDTH), np.float32), np.unique(bucket)
            np.add.at(gg, bucket, (dx[:, WIDTH:] / n[:, None])[gowner])
            steps.take("gram", net.p["gram"], gg[ig], ig)
    _calibrate(net, *aside, stands_for)
    return net


def _table(net: Network, words: list[bytes], rows: np.ndarray, back: bool = False):
    """Projected inputs of the words in ``rows`` (row 0: padding) and the windows in terms of it."""
    own, at = np.unique(rows, return_inverse=True)
    at = at.reshape(rows.shape)
    if own[0] == -1:
        own = own[1:]
    else:
        at = at + 1
    if not len(own):
        x, rest = np.zeros((0, 2 * WIDTH), np.float32), (np.zeros(0, np.int64),) * 3 + (np.ones(0, np.float32),)
    else:
        x, rest = net.inputs([words[k] for k in own])
    table = np.concatenate([net.padding(), net.projected(x)])
    return (table, at, (x, rest)) if back else (table, at)


def _calibrate(net: Network, texts: list[str], toxic: np.ndarray, stands_for: tuple[float, float] = (1.0, 1.0)) -> None:
    """Slope and shift of the logistic on the texts' largest logits: Newton steps with a weak prior, halved if needed.

    Rows weigh what their class ``stands_for``, in all as much as there are rows."""
    got = np.clip(Scorer(net).logits(texts), -60, 60)
    weight = np.where(toxic > 0, stands_for[1], stands_for[0])
    weight = weight * (len(weight) / weight.sum())
    middle, spread = got.mean(), got.std() + 1e-6
    x = np.stack([(got - middle) / spread, np.ones(len(got))])
    loss = lambda w: float((weight * np.logaddexp(0, w @ x)).sum() - (weight * toxic * (w @ x)).sum() + 0.05 * (w @ w))
    w = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(w @ x)
        step = np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + 0.1 * np.eye(2), x @ (weight * (p - toxic)) + 0.1 * w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    net.slope = float(max(w[0], 0.0) / spread)
    net.shift = float(w[1] - net.slope * middle)


class Scorer:
    """Scores texts, remembering the projected inputs of up to TABLE_ROWS words."""

    def __init__(self, net: Network):
        self.net, self.rows = net, {}
        self.table = np.zeros((TABLE_ROWS + 1, 6 * HIDDEN), np.float32)
        self.table[0] = net.padding()

    def _ids(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.rows.get, words))
        if None in found:
            new = list({w for w, f in zip(words, found, strict=True) if f is None})
            if len(self.rows) + len(new) > TABLE_ROWS:
                self.rows.clear()
                new = list(set(words))
            if len(new) > TABLE_ROWS:
                raise ValueError("more words in one call than the table holds")
            first = len(self.rows) + 1
            for k in range(0, len(new), 20_000):
                part = new[k : k + 20_000]
                self.table[first + k : first + k + len(part)] = self.net.projected(self.net.inputs(part)[0])
            self.rows.update(zip(new, range(first, first + len(new)), strict=True))
            found = [self.rows[w] for w in words]
        return np.array(found, np.int64)

    def logits(self, texts: list[str]) -> np.ndarray:
        """The largest logit of each text's windows."""
        out = np.full(len(texts), -np.inf)
        pending, owner, count = [], [], 0

        def flush():
            nonlocal pending, owner, count
            if pending:
                got = self.net.run(self.table, np.concatenate(pending))
                np.maximum.at(out, np.concatenate(owner), got)
            pending, owner, count = [], [], 0

        for k, text in enumerate(texts):
            words = tokens(text)
            starts = windows(len(words))
            for s in range(0, len(starts), SCORE_WINDOWS):  # a very long text in several rounds
                some = starts[s : s + SCORE_WINDOWS]
                first = int(some[0])
                if len(self.rows) + len(some) * WINDOW > TABLE_ROWS:
                    flush()  # rows may be renumbered: what was looked up is used before
                ids = self._ids(words[first : int(some[-1]) + WINDOW])
                if len(ids) < WINDOW:
                    grid = np.zeros((1, WINDOW), np.int64)
                    grid[0, : len(ids)] = ids
                else:
                    grid = ids[(some - first)[:, None] + np.arange(WINDOW)]
                pending.append(grid)
                owner.append(np.full(len(some), k))
                count += len(some)
                if count >= SCORE_WINDOWS:
                    flush()
        flush()
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return _sigmoid(self.net.slope * np.clip(self.logits(texts), -60, 60) + self.net.shift)


_SCORERS: dict[str, Scorer] = {}


def _scorer(net: Network) -> Scorer:
    """One scorer per Python worker and model."""
    if net.version not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[net.version] = Scorer(net)
    return _SCORERS[net.version]


def fitting(rows: list[tuple[int, int, int]], most: int) -> list[tuple[int, int]]:
    """(key, number) of the rows (key, number, size) that fit ``most`` in all, each tried in turn; the smallest if none fits."""
    out, used = [], 0
    for key, number, size in rows:
        if used + size <= most:
            out.append((key, number))
            used += size
    return out or [(key, number) for key, number, _ in sorted(rows, key=lambda x: x[2])[:1]]


def train(df: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Network:
    """Fit on at most ``max_rows`` toxic and CLEAN_SHARE times as many clean texts outside the held-out fold.

    A key with several labels has the largest; null keys and labels other than 0 and 1 are left out. Of rows that repeat a
    key ROWS_A_KEY count. Each label has its own bound of rows and of characters (a third of ``max_chars`` for toxic
    texts): in the order of a hash of the key, a text that doesn't fit any more is passed over and the next is tried. If
    none fits, the shortest one is taken. The sample is the same wherever rows lie.
    """
    own = labelled(labels, label, key)
    most = (max_rows * CLEAN_SHARE, max_rows)
    order = [F.xxhash64("_k"), "_k"]
    part = lambda v: own.filter(F.col("_label") == v).orderBy(*order).limit(most[v])
    count = {r["_label"]: r["count"] for r in own.groupBy("_label").count().collect()}
    stands_for = tuple(max(1.0, count.get(v, 0) / max(1, most[v])) for v in (0, 1))
    rows = df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    found = few_a_key(rows.join(F.broadcast(part(0).union(part(1))), F.col("doc_id") == F.col("_k")))
    # Sizes first (a few numbers a row, rows by label), then the texts of the rows that are in.
    sized = found.select("_k", "_label", "_n", F.length("text").alias("_chars"))
    first = lambda v: sized.filter(F.col("_label") == v).orderBy(*order, "_n").limit(most[v])
    sizes = first(0).union(first(1)).toPandas()
    taken = []
    for v, share in ((0, max_chars - max_chars // 3), (1, max_chars // 3)):
        taken += fitting([(int(k), int(n), int(c)) for k, n, c in sizes.loc[sizes["_label"] == v, ["_k", "_n", "_chars"]].itertuples(index=False)], share)
    chosen = df.sparkSession.createDataFrame(taken, "_k2 long, _n2 int")
    got = found.join(F.broadcast(chosen), (F.col("_k") == F.col("_k2")) & (F.col("_n") == F.col("_n2"))).select("doc_id", "text", "_label").toPandas()
    got = got.sort_values(["doc_id", "text"], kind="stable")
    return fit(got["text"].to_list(), got["_label"].to_numpy(), stands_for=stands_for)


def scored(df: DataFrame, net: Network, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``df`` and held_out, score, predicted; columns of these names are replaced.

    Null texts count as empty; an empty text is one window of padding and has the score of that. Repeated rows are
    scored alike; a null key has the fold of the empty text. An empty table gives an empty result.
    """
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(net)
    df = replaced(df, ("held_out", "score", "predicted"))
    names = df.columns
    own, *short = private([], "_text", *(f"_c{k}" for k in range(len(names))))

    @lean("toxicity", _SCORERS.clear)
    def run(batches):
        scorer = _scorer(shared.value)
        for batch in batches:
            for k in range(0, max(1, batch.num_rows), 512):
                part = batch.slice(k, 512)
                got = scorer.scores(part.column(len(names)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got, pa.float64())], [*short, "score"])

    # mapInArrow takes no names with dots: columns go by number.
    plain = df.select("*", text_or_empty(text).alias(own)).toDF(*short, own)
    out = plain.mapInArrow(run, schema_text(plain.drop(own)) + ", score double").toDF(*names, "score")
    return out.withColumns({"held_out": remainder(key, FOLDS) == 0, "predicted": (F.col("score") >= threshold).cast("int")})
