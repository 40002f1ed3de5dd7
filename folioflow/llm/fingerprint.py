"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes; a chunk ends where its low bits meet a mask, with normalised chunking: a
stricter mask before the wanted size and a looser one after, between a least and a largest size. The gear hash sees
the last ``WINDOW`` bytes only, so after an edit boundaries fall into step again and equal passages give equal chunks
wherever they stand. The fingerprint is the set of chunk digests, each weighted by its chunk's length.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import private, replaced, schema_text, text_or_empty

WINDOW = 16
LEAST, WANTED, MOST = 12, 48, 256
STRICT, LOOSE = 7, 4  # bits
ROWS_A_BUCKET, MOST_BUCKETS = 2_000, 1 << 14
BLOCK = 1 << 20
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _gear() -> np.ndarray:
    """256 odd-looking 32-bit numbers from a fixed rule: xxHash of each byte value."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=2016) for b in range(256)], np.uint32)


GEAR = _gear()


def candidates(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive) after which the loose and the strict mask are met, in ascending order."""
    loose, strict = [], []
    for start in range(0, len(data), BLOCK):
        before = min(start, WINDOW - 1)
        h = GEAR[np.frombuffer(data, np.uint8, count=min(len(data) - start, BLOCK) + before, offset=start - before)]
        step = 1
        while step < WINDOW:  # doubling: after it h[i] sums the last 2 * step bytes, each shifted by its distance
            shifted = h[:-step] << np.uint32(step)
            h[step:] += shifted
            step *= 2
        h = h[before:] >> np.uint32(32 - WINDOW)  # bits that all WINDOW bytes reach
        at = np.flatnonzero((h & np.uint32((1 << LOOSE) - 1)) == 0)
        loose.append(at + (start + 1))
        strict.append(at[(h[at] & np.uint32((1 << STRICT) - 1)) == 0] + (start + 1))
    if not loose:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(loose), np.concatenate(strict)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks: a strict one from LEAST to WANTED bytes, else a loose one up to MOST, else MOST."""
    loose, strict = (x.tolist() for x in candidates(data))
    out, at, i, j, n, nl, ns = [], 0, 0, 0, len(data), len(loose), len(strict)
    while at < n:
        low, mid, high = at + LEAST, at + WANTED, at + MOST
        while j < ns and strict[j] < low:
            j += 1
        if j < ns and strict[j] <= mid:
            at = strict[j]
        else:
            while i < nl and loose[i] <= mid:
                i += 1
            at = min(loose[i] if i < nl and loose[i] <= high else high, n)
        out.append(at)
    return out


def fingerprint(text: str) -> dict[int, int]:
    """digest -> bytes of the chunks that have it (equal chunks count once)."""
    data = text.encode()
    out, at, digest = {}, 0, xxhash.xxh64_intdigest
    for end in cuts(data):
        out[digest(data[at:end])] = end - at
        at = end
    return out


def named(print_: dict[int, int]) -> str:
    """A fingerprint's name: hex digest of its sorted chunk digests."""
    return hashlib.blake2b(np.array(sorted(print_), "<u8").tobytes(), digest_size=16).hexdigest()


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Bytes of shared chunks over those of the smaller set: 1 if one contains the other, or if both are empty."""
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b):
        a, b = b, a
    return sum(n for d, n in a.items() if d in b) / min(sum(a.values()), sum(b.values()))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns and fingerprint (string), chunks (digest and bytes) of each row; null texts count as empty."""
    df = replaced(df, ("fingerprint", "chunks"))
    (own,) = private(df.columns, "_text")
    names = df.columns

    def run(batches):
        kind = pa.list_(pa.struct([("digest", pa.int64()), ("bytes", pa.int32())]))
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(len(names))]
            chunks = [[{"digest": d - (1 << 64) if d >> 63 else d, "bytes": n} for d, n in p.items()] for p in prints]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([named(p) for p in prints]), pa.array(chunks, kind)], [*names, "fingerprint", "chunks"])

    return df.withColumn(own, text_or_empty(text)).mapInArrow(run, schema_text(df) + ", fingerprint string, chunks array<struct<digest:bigint,bytes:int>>")


def _bounds(keys: DataFrame, buckets: int) -> np.ndarray:
    """Rows (k, h): the first of a bucket each, in the order of k descending and h ascending, without the first bucket.

    Quantiles of ``keys`` (k), at most ``buckets`` of them. A key that is several quantiles holds several buckets' rows:
    it is cut by h, which is evenly spread there, into as many and one more (keys beyond 2**53 are not).
    """
    if buckets < 2:
        return np.zeros((0, 2), np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    found = Counter(min(int(x), high) for x in keys.approxQuantile("k", [i / buckets for i in range(1, buckets)], 0.25 / buckets))
    out = {(k, low) for k in found} | {(k, (i << 64) // (n + 1) + low) for k, n in found.items() if n > 1 for i in range(n + 1)}
    return np.array(sorted(out, key=lambda x: (-x[0], x[1])), np.int64).reshape(-1, 2)


def _placed(rows: DataFrame, bounds: np.ndarray, sees: dict | None = None) -> DataFrame:
    """``rows`` (k, h, ...) with bucket: how many bounds are at or before (k, h); and ahead = 0.

    ``sees``: the bucket that sees the row of some (k, h) besides its own; such rows come a second time, with ahead = 1.
    """
    shared = rows.sparkSession.sparkContext.broadcast((bounds, sees or {}))

    def run(batches):
        (k0, h0), more = shared.value[0].T, shared.value[1]
        keys, first = np.unique(~k0, return_index=True)  # k descending; where each key's bounds begin
        first = np.append(first, len(k0))
        watched = np.array(sorted({k for k, _ in more}), np.int64)
        for batch in batches:
            k, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            at = np.searchsorted(keys, ~k, "left")
            b = first[at]
            for x in np.flatnonzero((at < len(keys)) & (np.append(keys, 0)[at] == ~k)):
                b[x] += np.searchsorted(h0[first[at[x]] : first[at[x] + 1]], h[x], "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(b.astype(np.int32)), pa.array(np.zeros(len(b), np.int32))], [*batch.schema.names, "bucket", "ahead"])
            twice = [x for x in np.flatnonzero(np.isin(k, watched)).tolist() if (int(k[x]), int(h[x])) in more]
            if twice:
                seen = pa.array([more[int(k[x]), int(h[x])] for x in twice], pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(twice)).columns, seen, pa.array(np.ones(len(twice), np.int32))], [*batch.schema.names, "bucket", "ahead"])

    return rows.mapInArrow(run, schema_text(rows) + ", bucket int, ahead int")


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text", rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """RESULT: each text against its edited text and against the next document's, by descending key.

    The order is cut into buckets of about ``rows_a_bucket`` documents, MOST_BUCKETS at most, a task each; each bucket
    also gets the first document of the following one, so that texts shuffle once. Only bounds and the buckets' first
    keys reach the driver. Null texts are empty; a null key comes last. Rows of equal keys follow by their text, and
    those of a key with very many rows by a hash of the text first, so that they are spread as well. A single document
    follows itself. Other columns are not read; an empty table gives an empty result.
    """
    spark = df.sparkSession
    keys = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k"))
    rows = keys.count()
    if not rows:
        return spark.createDataFrame([], RESULT)
    bounds = _bounds(keys, max(1, min(MOST_BUCKETS, rows // rows_a_bucket)))
    many = [int(k) for k, n in Counter(bounds[:, 0].tolist()).items() if n > 1]
    k = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    h = F.when(k.isin(many), F.xxhash64(text_or_empty(text))).otherwise(F.lit(0).cast("long")) if many else F.lit(0).cast("long")
    keyed = df.select(k.alias("k"), h.alias("h"), F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    # The first row of every bucket that has rows, which the bucket before it must see.
    firsts = _placed(keyed.select("k", "h"), bounds).groupBy("bucket").agg(F.max(F.struct("k", F.bitwise_not("h").alias("h"))).alias("f")).orderBy("bucket").collect()
    sees = {(r["f"]["k"], ~r["f"]["h"]): firsts[n - 1]["bucket"] for n, r in enumerate(firsts)}
    dealt = _placed(keyed, bounds, sees).repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions("bucket", "ahead", F.desc("k"), "h", "text")

    def run(batches):
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        emit = lambda out: pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        def compared(one, two):
            doc, text, mine = one
            _, following, theirs = two
            changed = edited(text, following)
            other = mine if changed == text else fingerprint(changed)
            return (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), named(mine), named(other), containment(mine, other), containment(mine, theirs))

        before, bucket, ended, out = None, None, False, []
        for batch in batches:
            for doc, text, b, ahead in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4, 5)], strict=True):
                if b != bucket:
                    before, bucket, ended = None, b, False
                if ended:  # of rows ahead with one key the first counts
                    continue
                now = (doc, text, fingerprint(text))
                if before is not None:
                    out.append(compared(before, now))
                    if len(out) >= 1000:
                        yield emit(out)
                        out = []
                before, ended = now, bool(ahead)
        if out:
            yield emit(out)

    return dealt.mapInArrow(run, RESULT)
