"""Exact deduplication by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 finds the text hashes that occur more than once (8 bytes a text, counted in each task before they shuffle) and
sets HASHES bits of a Bloom filter for each of them. Pass 2 tests every row against the filter: all bits of a text that
occurs twice are set, so a row with a clear bit is certainly unique and passes straight through without a shuffle.
Only the remaining rows are hashed by SHA-256, grouped and joined with their group.

The filter grows with the repeated hashes, not with the rows: SLOTS of its bits for each, of which one in 270 unique
rows is taken for repeated. What is broadcast: the filter (at most ``2 ** max_bits / 8`` bytes, 128 MB by default, which
is enough for 33 million different repeated texts) and the hot groups (at most ``HOT_SHARE`` rows, see
``attach_groups``). Beyond that more rows count as possibly repeated and shuffle; the result does not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, discard, private, quoted, replaced, stored, text_or_empty

HASHES, WORD_BITS, MIN_BITS, MAX_BITS, SLOTS = 2, 15, 18, 30, 32
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def filter_bits(hashes: int, max_bits: int = MAX_BITS) -> int:
    """log2 of the filter's bits: SLOTS for each repeated hash, between fixed bounds."""
    return min(max_bits, max(MIN_BITS, (max(1, hashes) * SLOTS - 1).bit_length()))


def _slots(digest, bits: int):
    return [F.xxhash64(digest, F.lit(k)).bitwiseAND(F.lit((1 << bits) - 1)) for k in range(HASHES)]


def repeated_filter(df: DataFrame, text: str, max_bits: int) -> tuple[DataFrame, int]:
    """Pass 1: (word, bitmap) rows, 4 KB of bits a word, and log2 of the filter's bits."""
    hashes = df.select(F.xxhash64(text_or_empty(text)).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    hashes = stored(hashes, "repeated")
    bits = filter_bits(hashes.count(), max_bits)
    slots = hashes.select(F.explode(F.array(*_slots(F.col("h"), bits))).alias("slot"))
    word, bit = F.shiftright("slot", WORD_BITS).cast("int"), F.col("slot").bitwiseAND(F.lit((1 << WORD_BITS) - 1))
    out = stored(slots.groupBy(word.alias("word")).agg(F.bitmap_construct_agg(bit).alias("bitmap")), "bloom")
    discard(hashes)
    return out, bits


def _set(bitmap, slot):
    bit = slot.bitwiseAND(F.lit((1 << WORD_BITS) - 1))
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), bit.bitwiseAND(F.lit(7)).cast("int") + F.lit(1))
    return F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))


def possibly_repeated(df: DataFrame, found: DataFrame, text: str, bits: int, name: str) -> DataFrame:
    """Pass 2: ``df`` with the column ``name``."""
    flag, own = F.lit(True), df.columns
    for k, slot in enumerate(_slots(F.xxhash64(text_or_empty(text)), bits)):
        s, w, b = private([*own, name], f"_s{k}", f"_w{k}", f"_b{k}")
        side = F.broadcast(found.select(F.col("word").alias(w), F.col("bitmap").alias(b)))
        df = df.withColumn(s, slot).join(side, F.shiftright(F.col(s), WORD_BITS).cast("int") == F.col(w), "left")
        flag = flag & _set(F.col(b), F.col(s))
    return replaced(df.withColumn(name, flag), [c for c in df.columns if c not in own])


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """All columns of ``df`` and keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest key stays. Rows
    that repeat text and key alike cannot be told apart: all of them are kept = true. A null key never wins over
    another; if a group has none but null keys, keep_id is null and its rows are kept. Columns of ``df`` that bear
    the names of added ones are replaced; others may have any name. An empty table gives an empty result.
    """
    df = replaced(df, ADDED)
    (maybe_,) = private([*df.columns, *ADDED], "_maybe")
    rows = df.count()
    found, bits = repeated_filter(df, text, max_bits)
    digest = F.sha2(text_or_empty(text).cast("binary"), 256)
    flagged = possibly_repeated(df, found, text, bits, maybe_)
    maybe = flagged.filter(F.col(maybe_)).drop(maybe_).withColumn("text_sha256", digest)
    groups = stored(maybe.groupBy("text_sha256").agg(F.max(key).alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    again = attach_groups(maybe, groups, "text_sha256", "group_size", rows, key).withColumn("kept", F.col(key).eqNullSafe(F.col("keep_id")))
    single = flagged.filter(~F.col(maybe_)).drop(maybe_)
    single = single.withColumns({"text_sha256": digest, "keep_id": F.col(key), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    columns = [F.col(quoted(c)) for c in (*df.columns, *ADDED)]
    return single.select(*columns).unionByName(again.select(*columns))
