"""Hard-negative mining: exact search by integer inner products behind an orthogonal PCA rotation.

Vectors become integers, floor(scale * x). A rotation, fitted on a bounded sample, puts most of their length into the
leading components; being orthogonal, it changes no product. For a block of anchors and a block of rows the leading
components' partial products are one small matrix product. What the remaining components can add is at most the product
of both residual norms, so partial product plus that bound plus a slack for rounding is never below the true score; the
pair is discarded if this cannot reach what its anchor still needs. Survivors accumulate the middle components under a
smaller residual bound and are tested again; what is left is verified with integer products.

Every anchor has slots: an interval of admissible scores and the k best rows found in it. Positives have one slot
an anchor, negatives one for each of its positives. A task keeps its slots over all its blocks, so it sends k rows a slot
at most, and these are merged by one window a slot. Anchors go in waves of about WAVE_ROWS (the only data
that is broadcast), each wave against all rows in blocks: a stated query set, so no rows are joined in pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, lean, prepare, scratch, stored

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 5, 80, 100, 256
#: Rows of the sample that the rotation is fitted on, rows (and components in all) of a block, anchors compared with it at once, anchors of a wave.
SAMPLE_ROWS, BLOCK_ROWS, BLOCK_VALUES, ANCHOR_ROWS, WAVE_ROWS = 8_192, 2_048, 1 << 20, 256, 16_384
#: Leading and middle components; the share of pairs above which a whole block is verified at once, and components of pairs verified at once otherwise.
LEAD, MIDDLE, DENSE, PAIR_VALUES = 0.25, 0.5, 0.1, 1 << 22
#: Components after scaling, and components of a vector: with these, 100 times a product fits 64 bits.
MOST_COMPONENT, MOST_WIDTH = 1 << 22, 1 << 12
NONE, NO_ID = -(1 << 62), (1 << 63) - 1
BLOCKS = "rows int, first long, ids binary, labels binary, ints binary, turned binary"
FOUND = "anchor int, slot int, id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def clean(df: DataFrame, key: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """(id, label, x): rows that take part, x in integers (floor of ``scale`` times a component as double).

    Null keys, labels, vectors and components and components that are not finite leave a row out, and so do components
    beyond MOST_COMPONENT and vectors of more than MOST_WIDTH components.
    """
    x = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * F.lit(scale)))
    fine = F.forall(F.col(vector), lambda v: v.isNotNull() & (F.abs(v.cast("double") * F.lit(scale)) <= F.lit(float(MOST_COMPONENT))))  # NaN is larger than any number
    rows = df.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & fine & (F.size(F.col(vector)) <= MOST_WIDTH))
    return rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), x.cast("array<int>").alias("x"))


def rotation(sample: np.ndarray) -> np.ndarray:
    """Principal axes of the sample's vectors (not centred: products are), longest first, as columns."""
    d = sample.shape[1]
    return np.linalg.eigh(sample.T @ sample + 1e-9 * np.eye(d))[1][:, ::-1].copy()


def fitted_rotation(rows: DataFrame, width: int, most: int = SAMPLE_ROWS) -> np.ndarray:
    """The rotation by a sample of ``most`` rows with the smallest hash; any other would give the same results."""
    got = rows.orderBy(F.xxhash64("id"), "id").limit(most).select("x").toArrow().column(0)
    return rotation(np.array([padded(v.as_py(), width) for v in got], float).reshape(-1, width))


def padded(x: list[int], width: int) -> list[int]:
    return x + [0] * (width - len(x))


def blocks(rows: DataFrame, turn: np.ndarray) -> DataFrame:
    """BLOCKS of (id, label, x), in ascending order of id within a task: integers and rotated vectors as matrices."""
    width = len(turn)
    most = max(1, min(BLOCK_ROWS, BLOCK_VALUES // width))
    shared = rows.sparkSession.sparkContext.broadcast(turn)

    @lean("hard negatives")
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, most):
                part = batch.slice(k, most)
                ints = np.array([padded(v, width) for v in part.column(2).to_pylist()], np.int32).reshape(-1, width)
                turned = (ints @ shared.value).astype(np.float32)
                values = [part.num_rows, part.column(0)[0].as_py(), *(m.tobytes() for m in (part.column(0).to_numpy(), part.column(1).to_numpy(), ints, turned))]
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["rows", "first", "ids", "labels", "ints", "turned"])

    return rows.sortWithinPartitions("id").mapInArrow(run, BLOCKS)


@dataclass
class Block:
    """Rows as matrices; ``rest``: their residual norms after the leading and after the middle components, and in all."""

    ids: np.ndarray
    labels: np.ndarray
    ints: np.ndarray
    turned: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, ids: bytes, labels: bytes, ints: bytes, turned: bytes, width: int) -> Block:
        own = np.frombuffer(ints, np.int32).reshape(-1, width)
        turned = np.frombuffer(turned, np.float32).reshape(-1, width)
        length = (own.astype(np.float64) ** 2).sum(1)
        rest = [np.sqrt((turned[:, c:].astype(np.float64) ** 2).sum(1)) for c in cuts(width)]
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), own, turned, np.array([*rest, np.sqrt(length)]))

    def part(self, at: slice) -> Block:
        return Block(self.ids[at], self.labels[at], self.ints[at], self.turned[at], self.rest[:, at])


def cuts(width: int) -> tuple[int, int]:
    """How many components lead, and how many lead or are in the middle."""
    lead = min(width, max(1, round(width * LEAD)))
    return lead, min(width, max(lead, round(width * MIDDLE)))


def slack(width: int) -> float:
    """A bound of the rounding error of a partial product of ``width`` terms in four-byte floats, per product of lengths."""
    return (width + 16) * 2.0**-22


class Slots:
    """For each anchor ``low.shape[1]`` intervals of scores, and in each the ``k`` best rows so far: higher scores, then smaller ids."""

    def __init__(self, anchors: Block, low: np.ndarray, cap: np.ndarray, k: int, same: bool):
        self.anchors, self.low, self.cap, self.k, self.same = anchors, low, cap, k, same
        self.scores = np.full((*low.shape, k), NONE, np.int64)
        self.ids = np.full((*low.shape, k), NO_ID, np.int64)

    def add(self, block: Block) -> None:
        for k in range(0, len(self.anchors.ids), ANCHOR_ROWS):
            self._add(slice(k, k + ANCHOR_ROWS), block)

    def _survivors(self, at: slice, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor of ``at``, row) that the bounds leave."""
        own, width = self.anchors.part(at), block.ints.shape[1]
        # A slot asks for a score above its last row's, or as high where this block may have smaller ids.
        need = np.maximum(self.low[at], self.scores[at, :, -1] + (self.ids[at, :, -1] < block.ids.min()))
        need = np.where(self.low[at] <= self.cap[at], need, -NONE).min(1).astype(float)
        most = np.where(self.low[at] <= self.cap[at], self.cap[at], NONE).max(1).astype(float)
        lead, middle = cuts(width)
        partial = own.turned[:, :lead] @ block.turned[:, :lead].T
        bound = np.outer(own.rest[0], block.rest[0]) + slack(width) * np.outer(own.rest[2], block.rest[2])
        label = own.labels[:, None] == block.labels
        keep = (partial + bound >= need[:, None]) & (partial - bound <= most[:, None]) & ((label & (own.ids[:, None] != block.ids)) if self.same else ~label)
        a, r = np.nonzero(keep)
        if len(a) > DENSE * keep.size or middle == lead:
            return a, r
        more = partial[a, r].astype(float)
        pairs = max(1, PAIR_VALUES // width)
        for k in range(0, len(a), pairs):
            i, j = a[k : k + pairs], r[k : k + pairs]
            more[k : k + pairs] += np.einsum("ij,ij->i", own.turned[i, lead:middle], block.turned[j, lead:middle])
        bound = own.rest[1][a] * block.rest[1][r] + slack(width) * own.rest[2][a] * block.rest[2][r]
        left = (more + bound >= need[a]) & (more - bound <= most[a])
        return a[left], r[left]

    def _add(self, at: slice, block: Block) -> None:
        a, r = self._survivors(at, block)
        if not len(a):
            return
        own = self.anchors.ints[at]
        if len(a) > DENSE * len(own) * len(block.ids) and self.anchors.rest[2].max() * block.rest[2].max() < 2.0**52:
            score = (own.astype(float) @ block.ints.T.astype(float))[a, r].astype(np.int64)  # integers below 2**53 are exact
        else:
            pairs = max(1, PAIR_VALUES // own.shape[1])
            score = np.concatenate([np.einsum("ij,ij->i", own[a[k : k + pairs]], block.ints[r[k : k + pairs]], dtype=np.int64) for k in range(0, len(a), pairs)])
        ids = block.ids[r]
        a = a + at.start
        for slot in range(self.low.shape[1]):
            last, last_id = self.scores[a, slot, -1], self.ids[a, slot, -1]
            good = (score >= self.low[a, slot]) & (score <= self.cap[a, slot]) & ((score > last) | (score == last) & (ids < last_id))
            if good.any():
                self._merge(slot, a[good], score[good], ids[good])

    def _merge(self, slot: int, a: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        mine = np.unique(a)
        every = np.concatenate([np.repeat(mine, self.k), a])
        score = np.concatenate([self.scores[mine, slot].ravel(), score])
        ids = np.concatenate([self.ids[mine, slot].ravel(), ids])
        order = np.lexsort((ids, -score, every))
        starts = np.searchsorted(every[order], mine)
        best = order[(starts[:, None] + np.arange(self.k)).ravel()]
        self.scores[mine, slot], self.ids[mine, slot] = score[best].reshape(-1, self.k), ids[best].reshape(-1, self.k)

    def found(self) -> pa.RecordBatch:
        """FOUND: what the slots hold."""
        anchor, slot, place = np.nonzero(self.scores > NONE)
        values = (anchor.astype(np.int32), slot.astype(np.int32), self.ids[anchor, slot, place], self.scores[anchor, slot, place])
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["anchor", "slot", "id", "score"])


def best_rows(table: DataFrame, anchors: Block, low: np.ndarray, cap: np.ndarray, k: int, same: bool) -> DataFrame:
    """FOUND with rank: for each anchor and slot the k best rows of ``table`` (BLOCKS) of its label (``same``), or of others."""
    shared = table.sparkSession.sparkContext.broadcast((anchors, low, cap))
    width = anchors.ints.shape[1]

    @lean("hard negatives")
    def run(batches):
        slots = Slots(*shared.value, k, same)
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                slots.add(Block.of(*(v.as_py() for v in row), width))
        yield slots.found()

    each = table.select("ids", "labels", "ints", "turned").mapInArrow(run, FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _wave(table: DataFrame, anchors: Block, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """RESULT of one wave of anchors."""
    spark, n = table.sparkSession, len(anchors.ids)
    every = np.full((n, 1), NONE + 1, np.int64)
    near = best_rows(table, anchors, every, -every, positives, True).toArrow()  # ``positives`` rows an anchor at most
    score, ids = np.full((n, positives), NONE, np.int64), np.zeros((n, positives), np.int64)
    at = near["anchor"].to_numpy(), near["rank"].to_numpy() - 1
    score[at], ids[at] = near["score"].to_numpy(), near["id"].to_numpy()
    there = score > NONE
    # low * positive <= high * negative <= high * positive, in whole numbers; without a positive nothing is admissible.
    least = np.where(there, -((-low * score) // high), 1)
    found = best_rows(table, anchors, least, np.where(there, score, 0), negatives, False)
    a, s = np.nonzero(there)
    names = spark.createDataFrame(pa.table({"anchor": pa.array(a.astype(np.int32)), "slot": pa.array(s.astype(np.int32)), "anchor_id": anchors.ids[a], "positive_id": ids[a, s], "positive_score": score[a, s]}))
    out = found.join(F.broadcast(names), ["anchor", "slot"])
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(
    df: DataFrame, anchors: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """RESULT: for each row that the condition ``anchors`` (on the key) picks and each of its positives the hard negatives.

    Positives are the first ``positives`` rows of the same label with another key, negatives the first ``negatives`` rows
    of other labels with low * positive_score <= high * negative_score <= high * positive_score; fewer if there are
    fewer. Higher scores come first, ties by smaller key. ``clean`` says which rows take no part. Shorter vectors count as filled
    up with zeros. Rows that repeat a key are rows of their own, as candidates and as anchors; other columns, whatever their
    names, are not read. An empty table, or one without anchors, gives an empty result.
    """
    spark = prepare(df.sparkSession)
    rows = stored(clean(df, key, vector, label, scale), "vectors")
    width = max(1, rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0])
    turn = fitted_rotation(rows, width)
    table = stored(blocks(rows, turn), "blocks", **{"parquet.block.size": 8 << 20})
    heads = stored(blocks(rows.filter(anchors(F.col("id"))), turn), "anchors", **{"parquet.block.size": 8 << 20})
    numbered = heads.withColumn("_block", F.monotonically_increasing_id())
    path = scratch(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    waves, size = [[]], 0
    for number, n in numbered.select("_block", "rows").collect():  # one row a block
        if waves[-1] and size + n > WAVE_ROWS:
            waves.append([])
            size = 0
        waves[-1].append(number)
        size += n
    for wave in filter(None, waves):
        got = numbered.filter(F.col("_block").isin(wave)).select("ids", "labels", "ints", "turned").toArrow()
        asked = Block.of(*(b"".join(v.as_py() for v in c) for c in got.columns), width)
        _wave(table, asked, positives, negatives, low, high).write.mode("append").parquet(path)
    discard(rows, table, heads)
    return spark.read.schema(RESULT).parquet(path)
