"""LM scoring: a hashed maximum-entropy model with n-gram and skip features and class-factored softmax.

A token of the HEAD most frequent has a code of LEVELS digits to the base 16: words are grouped by the frequent words
that go before them, and numbered by group and frequency. Each digit is a softmax over 16 classes, given the digits
before (the node) and the history, down to the word. A digit's score is the unigram log probability at the node plus a
row of 16 weights per feature: the word before, the two before, the word before that (skip), and the last very
frequent word; LEVEL_FEATURES says which of them each level sees. Rows are hashed from feature, history and node into
a table that grows with the training tokens from 2**ROWS_LOG2 rows to 2**MOST_ROWS_LOG2, a part for each feature. All
other tokens share one code (RARE); within it a token's probability is its smoothed share of the rare tokens, so that
the probabilities of all tokens and of unknown ones sum to 1.

Steps: (1) counts of all tokens; (2) one pass over the texts stores each text's numbers (two bytes a token) and the
hashes of its rare tokens, which is all that the later steps read; (3) counts of all head tokens by the frequent word
before them, for the codes; (4) ROUNDS rounds, each over its share of the training texts. A round's shards (one per
TOKENS_A_SHARD tokens, so they grow with the corpus) take stochastic gradient steps from the same weights, and their
changes are averaged row by row, weighted by use; only the table, of bounded size, is collected and broadcast.
(5) Scoring looks up the weights in sparse numpy batches; rare tokens are joined with their counts by hash. No token's
rows are hot in that join: whatever is frequent in training is in the head, and what is frequent in other texts only
(at most HEAD tokens) is known where the texts are numbered.
"""

from __future__ import annotations

from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, remainder, stored, text_or_empty

FOLDS = 10
BASE, LEVELS = 16, 4
END, RARE, FIRST = 0, 1, 2
HEAD = BASE**LEVELS - FIRST
TOP = 64
#: The table has ROWS_A_TOKEN rows for a training token, within these bounds (2**21 rows are 32 MB); weights are kept in
#: units of 1/UNIT, a byte each, and lie within +-127/UNIT, so that four of them never overflow an exponential.
ROWS_LOG2, MOST_ROWS_LOG2, ROWS_A_TOKEN, FEATURES, UNIT = 17, 21, 4, 4, 16
#: Features of each level, each feature's sixteenths of the table and rate of learning.
LEVEL_FEATURES, PARTS, RATES = ((0, 1, 2, 3), (0, 1, 2, 3), (0, 1, 3), (0, 1)), (6, 8, 1, 1), (0.7, 1.0, 0.3, 0.05)
GROUPS, GROUP_STEPS = 8, 12
ROUNDS, TOKENS_A_SHARD, MOST_SHARDS, BLOCK = 2, 8_000_000, 4_096, 1 << 11
BATCH, RUN_TOKENS, COUNTER_WORDS = 4_096, 50_000, 500_000
#: A summed table comes to the driver in parts of about so many bytes, whatever the session's number of partitions.
PART_BYTES = 4 << 20
ALPHA = 0.1
#: What stands for the end of a text among tokens; it holds white space, so no word equals it.
END_TOKEN = b"\n"

_NODES = np.cumsum([0] + [BASE**k for k in range(LEVELS)])
_ONES = np.ones(BASE, np.float32)
_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def rows_log2(total: int) -> int:
    """The logarithm of the table's rows for ``total`` training tokens."""
    return min(MOST_ROWS_LOG2, max(ROWS_LOG2, (max(1, total * ROWS_A_TOKEN) - 1).bit_length()))


def tokens(text: str) -> list[bytes]:
    """Words of the text, A-Z in lower case, split at ASCII white space."""
    return text.encode().lower().split()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``tokens`` of all texts, one after the other, and where each text's begin (and the last one's end); cut by Arrow."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, ends = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    whole = pc.greater(pc.binary_length(words), 0)  # white space at the beginning or end of a text leaves an empty word there
    if whole.true_count < len(words):
        ends = np.append(0, np.cumsum(whole.to_numpy(zero_copy_only=False)))[ends]
        words = words.filter(whole)
    return words, ends


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(token, c, m): how often each token occurs in training rows and in all, END_TOKEN once a row.

    Counted in each task before they shuffle.
    """

    def counted(texts, held):
        found = pc.value_counts(words_of(texts)[0])
        token, m = pa.concat_arrays([found.field(0), pa.array([END_TOKEN])]), pa.concat_arrays([found.field(1), pa.array([len(texts)])])
        return pa.table({"token": token, "c": pa.array(np.zeros(len(m), np.int64)) if held else m, "m": m})

    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            texts, held = batch.columns
            new = [counted(texts.filter(mask), h) for mask, h in ((pc.invert(held), False), (held, True)) if mask.true_count]
            waiting, size = waiting + new, size + sum(map(len, new))
            if size > 2 * COUNTER_WORDS:
                waiting = [_added(waiting)]
                size = len(waiting[0])
                if size > COUNTER_WORDS:
                    yield from waiting[0].to_batches()
                    waiting, size = [], 0
        if waiting:
            yield from _added(waiting).to_batches()

    partial = df.select(text_or_empty(text).alias("text"), (remainder(key, FOLDS) == 0).alias("held")).mapInArrow(run, "token binary, c long, m long")
    return partial.groupBy("token").agg(F.sum("c").alias("c"), F.sum("m").alias("m"))


def _added(counts: list[pa.Table]) -> pa.Table:
    """One row a token of these tables, with its counts added up."""
    both = pa.concat_tables(counts).group_by("token", use_threads=False).aggregate([("c", "sum"), ("m", "sum")])
    return both.select(["token", "c_sum", "m_sum"]).rename_columns(["token", "c", "m"])


class Model:
    """The head's codes and counts, the unigram tables by node, and the weights."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int):
        self.total, self.distinct = total, distinct
        self.ends = sum(c for t, c in head if t == END_TOKEN)
        self.words = [(t, c) for t, c in head if t != END_TOKEN][:HEAD]
        #: A token's number: END, RARE, then the words by rank.
        self.ids = {t: k for k, (t, _) in enumerate(self.words, FIRST)} | {END_TOKEN: END}
        counts = np.array([c for _, c in self.words], float)
        self.rare_mass = total - counts.sum() - self.ends + ALPHA * (distinct - len(self.words) - (self.ends > 0) + 1)
        self.mass = np.concatenate([[self.ends + ALPHA, self.rare_mass], counts + ALPHA])
        self.log_base = np.log10(np.maximum(self.mass, 1e-300) / (total + ALPHA * (distinct + 1)))
        #: 1 and up for the TOP most frequent words, else 0.
        self.top = np.zeros(FIRST + len(self.words), np.int64)
        self.top[FIRST : FIRST + TOP] = np.arange(1, min(TOP, len(self.words)) + 1)
        self.rows_log2 = rows_log2(total)
        self.weights = np.zeros((1 << self.rows_log2, BASE), np.int8)
        self.used = np.zeros(len(self.weights), np.float32)
        self.ordered(np.arange(len(self.words)))

    def ordered(self, order: np.ndarray) -> None:
        """Give codes to the words (by rank) in this order; the unigram tables follow."""
        self.code = np.arange(FIRST + len(order))
        self.code[FIRST + order] = FIRST + np.arange(len(order))
        mass = np.zeros(BASE**LEVELS)
        mass[self.code] = self.mass
        tables = []
        for level in range(LEVELS):
            t = mass.reshape(BASE**level, BASE, -1).sum(2)
            whole = t.sum(1, keepdims=True)
            tables.append(np.where(whole > 0, np.log(np.maximum(t, 1e-30) / np.maximum(whole, 1e-30)), 0))
        self.prior = np.concatenate(tables).astype(np.float32)

    def floats(self) -> np.ndarray:
        """The weights as numbers of four bytes."""
        return self.weights * np.float32(1 / UNIT)

    def frequent_before(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each position the last of the TOP words before it in its text, 0 if none; ``ids`` are numbers."""
        n, at = len(ids), np.arange(len(ids))
        first = np.repeat(starts, np.diff(np.append(starts, n)))
        top = self.top[ids]
        last = np.concatenate([[-1], np.maximum.accumulate(np.where(top > 0, at, -1))[:-1]])
        return np.where(last >= first, top[np.maximum(last, 0)], 0)

    def histories(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hashes of each position's FEATURES, a row each; texts begin at ``starts``, and before them is END."""
        one = np.concatenate([[END], ids[:-1]])
        one[starts] = END
        two = np.concatenate([[END], one[:-1]])
        two[starts] = END
        one, two = one.astype(np.uint32), two.astype(np.uint32)
        values = (one, one * np.uint32(65_599) + two, two, self.frequent_before(ids, starts).astype(np.uint32))
        out = np.empty((FEATURES, len(ids)), np.uint32)
        for k, v in enumerate(values):
            h = (v + np.uint32(k + 1)) * _SALTS[k]
            h ^= h >> np.uint32(15)
            np.multiply(h, np.uint32(0x2C1B3C6D), out[k])
        return out


def table_rows(history: np.ndarray, node: np.ndarray, feature: int, log2: int) -> np.ndarray:
    """A feature's row at each position: in its own part of the table, by history and node."""
    h = history ^ ((node.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1))
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    part = 1 << (log2 - 4)
    return ((h.astype(np.uint64) * np.uint64(PARTS[feature] * part)) >> np.uint64(32)).astype(np.int64) + sum(PARTS[:feature]) * part


def _digits(codes: np.ndarray):
    """(level, node, digit) of codes."""
    for level in range(LEVELS):
        shift = 4 * (LEVELS - 1 - level)
        yield level, (codes >> (shift + 4)) + _NODES[level], (codes >> shift) & (BASE - 1)


def log_probabilities(model: Model, ids: np.ndarray, history: np.ndarray) -> np.ndarray:
    """log10 of the probability of each token's code, given its history."""
    out, codes = np.zeros(len(ids)), model.code[ids]
    for k in range(0, len(ids), BATCH):
        y, h = codes[k : k + BATCH], history[:, k : k + BATCH]
        each = np.arange(len(y)) * BASE
        for level, node, digit in _digits(y):
            units = np.zeros((len(y), BASE), np.int16)
            for f in LEVEL_FEATURES[level]:
                units += model.weights.take(table_rows(h[f], node, f, model.rows_log2), 0)
            s = model.prior.take(node, 0)
            s += units * np.float32(1 / UNIT)
            own = s.ravel()[each + digit]
            out[k : k + BATCH] += (own - np.log(np.exp(s, s) @ _ONES)) / np.float32(np.log(10))
    return out


def as_items(table: np.ndarray) -> np.ndarray:
    """``table`` with each row as one item, which numpy moves at once and not number by number."""
    return table.view(f"V{table.itemsize * table.shape[1]}").ravel()


def grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ``rows``, how often each occurs, positions in the order of their rows, and where each row begins there."""
    if not len(rows):
        return rows, rows, rows, rows
    low, bits = rows.min(), (len(rows) - 1).bit_length()
    key = (rows - low).astype(np.uint32 if int(rows.max() - low) >> (32 - bits) == 0 else np.uint64)  # four bytes sort faster
    key <<= bits
    key |= np.arange(len(rows), dtype=key.dtype)
    key.sort()
    order = (key & key.dtype.type((1 << bits) - 1)).astype(np.int64)
    key >>= bits
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key.take(starts).astype(np.int64) + low, np.diff(np.append(starts, len(rows))), order, starts


def sums(gradients: np.ndarray, times: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of the ``gradients`` (a row each) that ``grouped`` puts together."""
    out, many = gradients.take(order.take(starts), 0), np.flatnonzero(times > 1)
    if len(many):  # most rows occur once and need no sum
        each = times.take(many)
        alike = gradients.take(order[np.repeat(times > 1, times)], 0)
        total = np.add.reduceat(alike.view(np.complex64), np.cumsum(each) - each, 0)  # two columns in one number
        as_items(out).put(many, as_items(total), mode="clip")
    return out


def summed_by_row(rows: np.ndarray, gradients: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ``rows``, how often each occurs, and the sums of the ``gradients`` (a row each) that share one."""
    row, times, *where = grouped(rows)
    return row, times, sums(gradients, times, *where)


class Trainer:
    """Stochastic gradient steps on a copy of the weights; ``used`` counts the tokens that have moved each row."""

    def __init__(self, model: Model):
        self.model, self.weights, self.used = model, model.floats(), model.used.copy()
        self.items = as_items(self.weights)

    def learn(self, ids: np.ndarray, history: np.ndarray) -> None:
        """Steps over batches: of tokens that share a row, the gradients are summed."""
        codes = self.model.code[ids]
        for k in range(0, len(ids), BATCH):
            y, h = codes[k : k + BATCH], history[:, k : k + BATCH]
            each = np.arange(len(y)) * BASE
            for level, node, digit in _digits(y):
                s = self.model.prior.take(node, 0)
                rows = [table_rows(h[f], node, f, self.model.rows_log2) for f in LEVEL_FEATURES[level]]
                now = [self.weights.take(r, 0) for r in rows]
                for w in now:
                    s += w
                np.exp(s, s)
                s *= np.reciprocal(s @ _ONES)[:, None]
                s.ravel()[each + digit] -= 1
                for f, r, w in zip(LEVEL_FEATURES[level], rows, now, strict=True):
                    row, times, order, starts = grouped(r)
                    step = sums(s, times, order, starts)
                    used = self.used.take(row) + times.astype(np.float32)
                    self.used.put(row, used, mode="clip")
                    step *= (np.float32(-RATES[f]) / np.sqrt(used))[:, None]
                    step += w.take(order.take(starts), 0)
                    self.items.put(row, as_items(step), mode="clip")


def numbered(df: DataFrame, model: Model, common: dict[bytes, int], key: str, text: str) -> DataFrame:
    """A row per row of ``df``: _row, doc_id, held, part (its round), ids (numbers, two bytes each, the end last), common
    (struct: rare tokens with a count among the ``common`` ones, and their log10 of count and ALPHA) and rare (hash, n)."""
    shared = df.sparkSession.sparkContext.broadcast((model.ids, common))

    def run(batches):
        numbers, counts = shared.value
        by_rank = pa.array([t for t in numbers if t != END_TOKEN], pa.binary())
        by_hash = {xxhash.xxh64_intdigest(t, seed=42): c for t, c in counts.items()}
        frequent = np.sort(np.fromiter(by_hash, np.uint64, len(by_hash)))
        there = np.array([by_hash[h] for h in frequent.tolist()], np.int64)
        for batch in batches:
            words, ends = words_of(batch.column(batch.num_columns - 1))
            texts = len(ends) - 1
            found = pc.index_in(words, value_set=by_rank)
            ids = (found.fill_null(RARE - FIRST).to_numpy() + FIRST).astype(np.uint16)
            ids = np.insert(ids, ends[1:], np.uint16(END)).tobytes()
            starts = (ends + np.arange(texts + 1)).tolist()
            # A row for each text and rare token of it, with how often it stands there.
            missing = words.filter(found.is_null()).to_numpy(zero_copy_only=False)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, missing, repeat(42)), np.uint64, len(missing))
            at = np.repeat(np.arange(texts), np.diff(ends))[found.is_null().to_numpy(zero_copy_only=False)]
            order = np.lexsort((hashes, at))
            hashes, at = hashes[order], at[order]
            first = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (at[1:] != at[:-1]))[: len(at)])
            n, hashes, at = np.diff(np.append(first, len(at))), hashes[first], at[first]
            near = np.searchsorted(frequent, hashes)
            held = (frequent[np.minimum(near, len(frequent) - 1)] == hashes) if len(frequent) else np.zeros(len(hashes), bool)
            c, k, many = there[near[held]], at[held], n[held]
            parts = ((many, np.int64), (many * (c > 0), np.int64), (many * np.log10(c + ALPHA), np.float64))
            common_ = pa.StructArray.from_arrays([pa.array(np.bincount(k, w, texts).astype(kind)) for w, kind in parts], ["n", "known", "log"])
            rare = pa.StructArray.from_arrays([pa.array(hashes[~held].view(np.int64)), pa.array(n[~held].astype(np.int32))], ["h", "n"])
            offsets = np.append(0, np.cumsum(np.bincount(at[~held], minlength=texts))).astype(np.int32)
            raw = pa.array([ids[2 * a : 2 * b] for a, b in pairwise(starts)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], raw, common_, pa.ListArray.from_arrays(pa.array(offsets), rare)], [*batch.schema.names[:-1], "ids", "common", "rare"])

    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(key).cast("long").alias("doc_id"), (remainder(key, FOLDS) == 0).alias("held"), F.pmod(F.xxhash64(F.col(key)), F.lit(ROUNDS)).cast("int").alias("part"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "_row long, doc_id long, held boolean, part int, ids binary, common struct<n:long,known:long,log:double>, rare array<struct<h:long,n:int>>")


def _runs(values, most: int = RUN_TOKENS):
    """(ids, starts) of runs of texts (arrays of stored numbers) with about ``most`` tokens; a longer text is a run of its own."""
    parts, starts, size = [], [], 0
    for raw in values:
        starts.append(size)
        parts.append(np.frombuffer(raw, np.uint16))
        size += len(parts[-1])
        if size >= most:
            yield np.concatenate(parts).astype(np.int64), np.array(starts)
            parts, starts, size = [], [], 0
    if parts:
        yield np.concatenate(parts).astype(np.int64), np.array(starts)


def _summed(parts: DataFrame, weigh: bool, cells: int) -> DataFrame:
    """Sums of (block, value, used) by block; with ``weigh``, means weighted by ``used`` and its mean. Parts stream, a sum is held.

    ``cells``: numbers in the whole table.
    """
    kind = np.int8 if weigh else np.float32

    def merge(batches):
        now, total, weight, square = None, None, None, None

        def out():
            share = np.maximum(weight, 1e-9)
            mean, use = (total / share[:, None], square / share) if weigh else (total, weight)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([mean.astype(np.float32).tobytes()], pa.binary()), pa.array([use.astype(np.float32).tobytes()], pa.binary())], ["block", "value", "used"])

        for batch in batches:
            for block, value, used in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if block != now:
                    if now is not None:
                        yield out()
                    now, total, weight, square = block, 0.0, 0.0, 0.0
                u = np.frombuffer(used, np.float32).astype(np.float64)
                v = np.frombuffer(value, kind).reshape(len(u), -1).astype(np.float64)
                total = total + (v * u[:, None] if weigh else v)
                weight, square = weight + u, square + u * u
        if now is not None:
            yield out()

    return parts.repartition(-(-4 * cells // PART_BYTES), "block").sortWithinPartitions("block").mapInArrow(merge, "block int, value binary, used binary")


def _bytes(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x), -127, 127).astype(np.int8)


def _blocks(table: np.ndarray, used: np.ndarray, packed=lambda x: x):
    """A table as rows of (block, values, use), leaving out blocks without use."""
    for k in range(0, len(table), BLOCK):
        if used[k : k + BLOCK].any():
            yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([packed(table[k : k + BLOCK]).tobytes()], pa.binary()), pa.array([used[k : k + BLOCK].astype(np.float32).tobytes()], pa.binary())], ["block", "value", "used"])


def _collected(merged: DataFrame):
    """(rows of the table, their values, their use) of one block after the other."""
    for row in merged.toLocalIterator():
        used = np.frombuffer(row["used"], np.float32)
        first = row["block"] * BLOCK
        yield slice(first, first + len(used)), np.frombuffer(row["value"], np.float32).reshape(len(used), -1), used


def profiles(rows: DataFrame, model: Model, shards: int) -> np.ndarray:
    """How often each word of ``model`` (by rank) stands after each of the TOP words, or none of them."""
    top = model.top
    shared = rows.sparkSession.sparkContext.broadcast(top)

    def run(batches):
        m, wide = Model.__new__(Model), TOP + 1
        m.top = shared.value
        count, keys, waiting = np.zeros(len(m.top) * wide, np.int64), [], 0
        for ids, starts in _runs(v.as_py() for batch in batches for v in batch.column(0)):
            keys.append(ids * wide + m.frequent_before(ids, starts))
            waiting += len(ids)
            if waiting > 4_000_000:
                count += np.bincount(np.concatenate(keys), minlength=len(count))
                keys, waiting = [], 0
        if keys:
            count += np.bincount(np.concatenate(keys), minlength=len(count))
        table = count.reshape(-1, wide).astype(np.float32)
        yield from _blocks(table, table.sum(1))

    parts = rows.select("ids").coalesce(shards).mapInArrow(run, "block int, value binary, used binary")
    out = np.zeros((len(top), TOP + 1), np.float32)
    for at, value, _ in _collected(_summed(parts, False, out.size)):
        out[at] = value
    shared.destroy()
    return out[FIRST:]


def grouped_order(profile: np.ndarray, counts: np.ndarray, groups: int = GROUPS, steps: int = GROUP_STEPS) -> np.ndarray:
    """Words (by rank) in the order of their groups, by k-means on how much more often than usual a frequent word precedes.

    The first centres are far apart: each next one is the word, among the most frequent, least like those before.
    """
    if len(profile) <= groups:
        return np.arange(len(profile))
    usual = profile.sum(0) + 1.0
    usual /= usual.sum()
    x = np.log((profile + 20 * usual) / ((profile.sum(1) + 20)[:, None] * usual)).astype(np.float32)
    x *= np.sqrt(usual).astype(np.float32)
    weight = np.sqrt(counts.astype(np.float32))
    lead = x[: 50 * groups]
    centres = [lead[0]]
    while len(centres) < groups:
        centres.append(lead[np.min([((lead - c) ** 2).sum(1) for c in centres], 0).argmax()])
    centres = np.array(centres)
    for _ in range(steps):
        near = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        for g in range(groups):
            if (near == g).any():
                centres[g] = np.average(x[near == g], 0, weight[near == g])
    return np.lexsort((np.arange(len(near)), near))


def _round(rows: DataFrame, model: Model, shards: int) -> None:
    """The shards' changes, averaged row by row, added to the weights."""
    shared = rows.sparkSession.sparkContext.broadcast(_lean(model))

    def train(batches):
        own = Trainer(shared.value)
        for ids, starts in _runs(v.as_py() for batch in batches for v in batch.column(0)):
            own.learn(ids, own.model.histories(ids, starts))
        change = own.weights
        change *= UNIT
        change -= own.model.weights
        yield from _blocks(change, own.used - own.model.used, _bytes)

    parts = rows.select("ids").coalesce(shards).mapInArrow(train, "block int, value binary, used binary")
    for at, change, used in _collected(_summed(parts, True, model.weights.size)):
        model.weights[at] = _bytes(model.weights[at] + change)
        model.used[at] += used
    shared.destroy()


def _lean(model: Model) -> Model:
    """``model`` without what only numbering needs: the words."""
    out = Model.__new__(Model)
    out.__dict__ = model.__dict__ | {"ids": None, "words": None}
    return out


def _head(counts: DataFrame, by: str, most: int) -> list:
    """Rows of ``counts`` with the largest ``by`` (above 1): all above the least one that at most ``most`` rows exceed.

    Only (count, tokens with it) pairs are ranked, so no task sends more rows than there are distinct high counts.
    """
    got, least = 0, 1
    for c, n in counts.filter(F.col(by) > 1).groupBy(by).count().orderBy(F.desc(by)).limit(most).collect():
        got += n
        if got > most:
            least = c
            break
    else:
        least = 0 if counts.count() <= most else 1
    return counts.filter(F.col(by) > least).collect()


def train(rows: DataFrame, model: Model) -> Model:
    """Fit ``model`` on the ``numbered`` rows outside the held-out fold."""
    shards = max(1, min(MOST_SHARDS, -(-model.total // (ROUNDS * TOKENS_A_SHARD))))
    mine = rows.filter("not held")
    if model.words:
        model.ordered(grouped_order(profiles(mine, model, shards * ROUNDS), np.array([c for _, c in model.words])))
    for k in range(ROUNDS if model.total else 0):
        _round(mine.filter(F.col("part") == k), model, shards)
    return model


def scored(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of ``numbered`` rows."""
    lean = _lean(model)
    lean.used = None
    shared = rows.sparkSession.sparkContext.broadcast(lean)
    names = ["_row", "doc_id", "held", "n_tokens", "n_known", "base_score", "score", "rare"]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    schema = "_row long, doc_id long, held boolean, n_tokens long, n_known long, base_score double, score double, rare array<struct<h:long,n:int>>"
    log_total, log_rare = (float(np.log10(x)) if x > 0 else 0.0 for x in (model.total + ALPHA * (model.distinct + 1), model.rare_mass))

    def run(batches):
        m = shared.value
        for batch in batches:
            done, lasting = 0, batch.column(4)
            n_rare, known, log = (lasting.field(k).to_numpy() for k in range(3))
            for ids, starts in _runs(v.as_py() for v in batch.column(3)):
                part, n = slice(done, done + len(starts)), len(starts)
                head = ids != RARE
                score = np.add.reduceat(log_probabilities(m, ids, m.histories(ids, starts)), starts)
                base = np.add.reduceat(np.where(head, m.log_base[ids], 0.0), starts)
                seen = np.add.reduceat((head & ((ids != END) | (m.ends > 0))).astype(np.int64), starts)
                values = [x.slice(done, n) for x in (batch.column(0), batch.column(1), batch.column(2))]
                values += [pa.array(x, k) for x, k in zip((np.diff(np.append(starts, len(ids))), seen + known[part], base + log[part] - n_rare[part] * log_total, score + log[part] - n_rare[part] * log_rare), kinds[3:], strict=True)]
                yield pa.RecordBatch.from_arrays([*values, batch.column(5).slice(done, n)], names)
                done += n

    texts = rows.select("_row", "doc_id", "held", "ids", "common", "rare").mapInArrow(run, schema)
    # A text's own figures ride on the first of its rare tokens, or on a row with n = 0 under a key of its own.
    main = ("doc_id", "held", "n_tokens", "n_known", "base_score", "score")
    one = texts.select("_row", *main, F.posexplode_outer("rare").alias("_at", "_x"))
    lead = F.coalesce(F.col("_at"), F.lit(0)) == 0
    one = one.select("_row", *[F.when(lead, F.col(c)).alias(c) for c in main], F.coalesce("_x.h", F.xxhash64("_row")).alias("_h"), F.coalesce("_x.n", F.lit(0)).alias("_n"))
    c = F.coalesce("c", F.lit(0))
    share = lambda mass: F.sum(F.col("_n") * (F.log10(c + F.lit(ALPHA)) - F.lit(mass)))
    by_hash = counts.filter("c > 0").groupBy(F.xxhash64("token").alias("_k")).agg(F.sum("c").alias("c"))  # should two tokens share a hash, no row doubles
    joined = one.join(by_hash, F.col("_h") == F.col("_k"), "left")
    out = joined.groupBy("_row").agg(
        *[F.max(x).alias(x) for x in ("doc_id", "held", "n_tokens")], (F.max("n_known") + F.coalesce(F.sum(F.when(c > 0, F.col("_n"))), F.lit(0))).alias("n_known"),
        (F.max("base_score") + share(log_total)).alias("base_score"), (F.max("score") + share(log_rare)).alias("score"),
    )
    return out.select("doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def fitted(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Model, DataFrame]:
    """The stored ``numbered`` rows, the trained model and the stored counts."""
    prepare(df.sparkSession)
    counts = stored(token_counts(df, key, text), "token-counts")
    total, distinct = counts.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head = sorted(((bytes(r["token"]), r["c"]) for r in _head(counts.filter("c > 0"), "c", HEAD + 1)), key=lambda x: (-x[1], x[0]))
    model = Model(head, total, distinct)
    common = {bytes(r["token"]): r["c"] for r in _head(counts, "m", HEAD + 1) if bytes(r["token"]) not in model.ids}
    rows = stored(numbered(df, model, common, key, text), "numbered")
    return rows, train(rows, model), counts


def lm_score(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row: count, train and score.

    A null text counts as empty and has one token, the end. Repeated rows are scored alike, each on its own; a null
    key has the fold of the empty text. Other columns are not read; an empty table gives an empty result. With no
    training rows every token is unknown. Memory is bounded by the table, the head's words and one text's numbers.
    """
    return scored(*fitted(df, key, text))
