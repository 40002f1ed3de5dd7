"""Importance resampling towards a target distribution, by an external sort-count of hashed n-grams.

Steps: (1) every text becomes a stream of buckets, two bytes a feature; tasks write packed streams of about
STREAM_FEATURES features with the offsets of their documents to the shared folder. (2) Each task sorts its streams one
by one, run-length encodes them and merges the runs, so it sends one row per bucket; the sums, at most ``buckets``
rows, give the gains. (3) The same streams are read again: gains are gathered and summed per document by
``np.add.reduceat``. (4) Scores are ranked without a global sort: the driver gets the number of documents of each
score (integers within a range that does not grow with the corpus), and only documents of one score are ordered.

Memory: one stream and one block of a text's words in a task; ``buckets`` gains are broadcast, and so are the scores
that are drawn (fewer than MOST_SCORES, see ``ranked``). Texts of any length are read whole, in blocks.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, prepare, stored

BUCKETS, MOST_WORDS, SHARE, LEAST_WORDS, SEED = 10_000, 2, 25, 20, 7
#: Features of a packed stream, bytes of a text that are cut into words at once, and runs that are held before they are merged.
STREAM_FEATURES, BLOCK_BYTES, RUNS = 1 << 16, 1 << 20, 64
#: Gains lie within 1000 * ln(2**64), Gumbel noise of 32 bits within -3.2 and 22.9 thousand.
MOST_SCORES = 120_000
#: Repeats of one row are written out so many at a time.
COPIES = 1 << 20
STREAMS = "keys array<bigint>, words array<bigint>, offsets array<bigint>, stream binary"
WEIGHTS = "doc_id long, n_words long, n_features long, weight long"

#: A-Z in lower case; all that is neither a letter, a digit nor beyond ASCII is a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _word_blocks(raw: bytes, size: int):
    """The words of a text, about ``size`` bytes of it at a time."""
    raw, start = raw.translate(_TABLE), 0
    while len(raw) - start > size:
        cut = raw.find(b" ", start + size)
        if cut < 0:
            break
        yield raw[start:cut].split()
        start = cut
    yield raw[start:].split()


def features(raw: bytes, most: int = MOST_WORDS, buckets: int = BUCKETS, size: int = BLOCK_BYTES) -> tuple[np.ndarray, int]:
    """The buckets (uint16) of all runs of 1 to ``most`` words of a text in UTF-8, and its number of words.

    A run's crc32 goes on from that of the run without its last word, so no run is ever joined.
    """
    out, tail, n = [np.zeros(0, np.uint16)], [], 0
    for fresh in _word_blocks(raw, size):
        words = tail + fresh
        n += len(fresh)
        spaced, crcs = [b" " + w for w in words], list(map(crc32, words))
        for k in range(most):  # crcs[i]: the run of k + 1 words that begins at word i
            if k:
                crcs = list(map(crc32, spaced[k:], crcs))
            new = crcs[max(0, len(tail) - k) :]
            out.append((np.array(new, np.uint32) % np.uint32(buckets)).astype(np.uint16))
        tail = words[max(0, len(words) - most + 1) :]
    return np.concatenate(out), n


def bucket_streams(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """STREAMS: documents one after the other, their buckets packed; ``offsets`` has one entry more than ``keys``."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket has two bytes")
    kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())

    def packed(keys, words, offsets, parts):
        values = (keys, words, offsets, np.concatenate(parts).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["keys", "words", "offsets", "stream"])

    @lean("importance")
    def run(batches):
        keys, words, offsets, parts = [], [], [0], []
        for batch in batches:
            for one, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found, n = features(raw.as_py(), most, buckets)
                keys.append(one)
                words.append(n)
                parts.append(found)
                offsets.append(offsets[-1] + len(found))
                if offsets[-1] + len(keys) >= STREAM_FEATURES:
                    yield packed(keys, words, offsets, parts)
                    keys, words, offsets, parts = [], [], [0], []
        if keys:
            yield packed(keys, words, offsets, parts)

    return df.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")).mapInArrow(run, STREAMS)


def _merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs of (bucket, count) as one."""
    values, counts = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.argsort(values, kind="stable")
    values = values[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def bucket_counts(streams: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket stands in the streams."""

    def run(batches):
        runs = []
        for batch in batches:
            for raw in batch.column(0):
                stream = np.sort(np.frombuffer(raw.as_py(), np.uint16), kind="stable")
                runs.append((stream, np.ones(len(stream), np.int64)))
                runs[-1] = _merged(runs[-1:])
                if len(runs) >= RUNS:
                    runs = [_merged(runs)]
        if runs:
            values, counts = _merged(runs)
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int32)), pa.array(counts)], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in streams.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: a thousand times the log of how much likelier the target has it, both smoothed by one, rounded down."""
    buckets = len(source)
    return np.floor(1000 * np.log((target + 1.0) * (source.sum() + float(buckets)) / ((source + 1.0) * (target.sum() + float(buckets))))).astype(np.int64)


def weighed(streams: DataFrame, gain: np.ndarray) -> DataFrame:
    """WEIGHTS of the streams' documents: the floored mean of their features' gains, 0 without features."""
    shared = streams.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for batch in batches:
            for keys, words, offsets, stream in zip(*batch.columns, strict=True):
                at = np.array(offsets.as_py(), np.int64)
                sizes = np.diff(at)
                found = shared.value[np.frombuffer(stream.as_py(), np.uint16)]
                total = np.where(sizes > 0, np.add.reduceat(np.append(found, 0), at[:-1]), 0)  # an empty stretch would give its first element
                values = [pa.array(keys.as_py(), pa.int64()), pa.array(words.as_py(), pa.int64()), pa.array(sizes), pa.array(total // np.maximum(sizes, 1))]
                yield pa.RecordBatch.from_arrays(values, ["doc_id", "n_words", "n_features", "weight"])

    return streams.mapInArrow(run, WEIGHTS)


def with_score(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """``weights`` with score: weight and Gumbel noise in thousandths, from a hash of seed and key (a null key is empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weights.withColumn("score", F.col("weight") + noise.cast("long"))


def ranked(weights: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``weights`` (stored, with score) with rank: 1, 2, ... for the ``share`` percent of highest scores among documents of
    ``least_words`` words or more, else null.

    Ties go by key (null last), n_features, weight and n_words. Rows that are alike in all of these are counted before
    they shuffle and written out again after, so no task gets the repeats of one row.
    """
    spark, fit = weights.sparkSession, F.col("n_words") >= least_words
    steps = sorted(((r["score"], r["n"]) for r in weights.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    draw = share * sum(n for _, n in steps) // 100
    marks, above = [], 0
    for score, n in steps:
        if above >= draw:
            break
        marks.append((score, above))
        above += n
    columns = weights.columns
    if not marks:
        return weights.withColumn("rank", F.lit(None).cast("long"))
    others = weights.filter(~fit | (F.col("score") < marks[-1][0])).withColumn("rank", F.lit(None).cast("long"))
    found = weights.filter(fit).join(F.broadcast(spark.createDataFrame(marks, "score long, above long")), "score")
    alike = found.groupBy("above", *columns).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight", "n_words")
    first = F.col("above") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    parts = alike.withColumn("first", first).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    rest = F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES)
    each = parts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), rest.cast("long"))))
    rank = F.col("first") + F.col("part") * COPIES + F.col("copy")
    return each.select(*columns, F.when(rank <= draw, rank).alias("rank")).unionByName(others)


def resample(
    df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", share: int = SHARE, least_words: int = LEAST_WORDS,
    seed: int = SEED, most: int = MOST_WORDS, buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``df``; drawn rows have a rank.

    Null and empty texts have no words, no features and weight 0, and are never drawn. A null key is hashed as the
    empty text. Rows that repeat are weighed and drawn each. Other columns, whatever their names, are not read. An empty
    table gives an empty result; without a target every gain comes from ``df`` alone.
    """
    prepare(df.sparkSession)
    streams = stored(bucket_streams(df, key, text, most, buckets), "streams", **{"parquet.block.size": 8 << 20})
    wanted = bucket_counts(bucket_streams(target.select(F.lit(None).cast("long").alias("k"), F.col(target_text).alias("t")), "k", "t", most, buckets), buckets)
    gain = gains(bucket_counts(streams, buckets), wanted)
    return ranked(stored(with_score(weighed(streams, gain), seed), "weights"), share, least_words)


def drawn(df: DataFrame, ranks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose key was drawn; rows that share a key stay or go together."""
    wanted = ranks.filter("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return df.join(wanted, F.col(key).eqNullSafe(F.col("_drawn")), "left_semi")
