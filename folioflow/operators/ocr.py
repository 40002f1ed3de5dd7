"""OCR fragments: roles, alignment with a context, and a summary that says how far to trust them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import alignment_terms, collapsed

W = r"[\p{L}\p{N}_]"
_A, _Z = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)"
# Roles in the order of their tests; (pattern, on lower case).
ROLES = (
    ("panel_label", r"^[A-Za-z]$", False),
    ("statistical_marker", _A + r"p\s*[<=>]\s*0?\.\p{Nd}+", True),
    ("statistical_marker", _A + "ns" + _Z + r"|[*]", False),
    ("sample_size", _A + r"n\s*[=:]\s*\p{Nd}+", True),
    ("statistical_marker", _A + r"(r2|r\^2|r²|ci|sem|sd|anova|t-test|ttest)" + _Z, True),
    ("measurement_or_unit", _A + r"(mg|g|kg|ml|l|µl|ul|µm|um|mm|cm|nm|h|hr|day|days|min|s)" + _Z + f"|{W}%{W}", True),
    ("condition_or_group", _A + r"(control|ctrl|mock|vehicle|wild[- ]?type|wt|ko|knockout|treated|untreated|low|high)" + _Z, True),
    ("biological_entity_or_label", r"[A-Za-z][0-9]|[A-Z]{2,}", False),
    ("axis_or_dimension", _A + r"(expression|relative|activity|concentration|survival|viability|response|rate|fold)" + _Z, True),
    ("numeric_value", r"^[-+]?\p{Nd}+(\.\p{Nd}+)?$", False),
)
USEFUL = ("panel_label", "axis_or_dimension", "condition_or_group", "biological_entity_or_label", "measurement_or_unit", "statistical_marker", "sample_size")
# Thresholds and the sentence where there is nothing to summarise.
UNAVAILABLE = "OCR unavailable or returned no usable text."
CONFIDENT, DOUBTFUL, LEAST_SCORE, MOST_ITEMS, CONTEXT_CHARS, TEXT_CHARS, TERMS_SHOWN = 0.55, 0.35, 2, 18, 60_000, 120, 5


def alignment(caption: Column, abstract: Column, context: Column) -> Column:
    """All that a fragment may align with: caption, abstract and the beginning of the context."""
    none = lambda c: F.coalesce(c, F.lit(""))
    return F.concat_ws(" ", none(caption), none(abstract), F.substring(none(context), 1, CONTEXT_CHARS))


def role(text: Column) -> Column:
    """What a fragment seems to be; the first test that matches decides."""
    out = None
    for name, pattern, lower in ROLES:
        test = (F.lower(text) if lower else text).rlike(pattern)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("unknown")


def scored(fragments: DataFrame, contexts: DataFrame) -> DataFrame:
    """Fragments (item_id, pos, text, confidence) with role, overlap, score and what counts against them.

    ``contexts`` are (item_id, alignment): all that a fragment may align with. Blank fragments have a null score.
    """
    flat = fragments.withColumns({"text": collapsed("text"), "confidence": F.coalesce("confidence", F.lit(0.0))})
    terms = contexts.select("item_id", alignment_terms("alignment").alias("_terms"))
    rows = flat.join(terms, "item_id", "left").withColumn("role", role(F.col("text")))
    overlap = F.array_sort(F.array_intersect(alignment_terms("text"), F.coalesce("_terms", F.array().cast("array<string>"))))
    rows = rows.withColumn("overlap", overlap).drop("_terms")
    aligned, c = F.size("overlap") > 0, F.col("confidence")
    lone, doubtful = (F.col("role") == "numeric_value") & ~aligned, (c < DOUBTFUL) & ~aligned
    points = lambda test, n: F.when(test, n).otherwise(0)
    score = points(c >= CONFIDENT, 1) + points(aligned, 3) + points(F.col("role").isin(*USEFUL), 2) - points(lone, 2) - points(doubtful, 2)
    return rows.withColumns({"isolated_numeric": lone & (F.col("text") != ""), "low_confidence": doubtful & (F.col("text") != ""), "score": F.when(F.col("text") != "", score)})


def reason(confidence: Column, overlap: Column, role_: Column) -> Column:
    parts = F.concat_ws(
        "; ",
        F.when(confidence >= CONFIDENT, "ocr_confidence_ok"),
        F.when(F.size(overlap) > 0, F.concat(F.lit("context_aligned:"), F.array_join(F.slice(overlap, 1, TERMS_SHOWN), ","))),
        F.when(role_.isin(*USEFUL), F.concat(F.lit("role="), role_)),
    )
    return F.when(parts == "", "contextual_candidate").otherwise(parts)


def kept(fragments: DataFrame, most: int = MOST_ITEMS) -> DataFrame:
    """Fragments of LEAST_SCORE and more, known roles and confident ones first, each text once, at most ``most`` an item."""
    named = F.when(F.col("role") == "unknown", "unknown_but_context_aligned").otherwise(F.col("role"))
    rows = fragments.filter(F.col("score") >= LEAST_SCORE).select("item_id", "pos", F.substring("text", 1, TEXT_CHARS).alias("text"), named.alias("role"), F.round("confidence", 3).alias("confidence"), reason(F.col("confidence"), F.col("overlap"), F.col("role")).alias("reason"))
    order = [F.col("role") == "unknown_but_context_aligned", F.desc("confidence"), F.col("pos")]
    once = rows.withColumn("_n", F.row_number().over(Window.partitionBy("item_id", F.lower("text")).orderBy(*order))).filter("_n = 1")
    return once.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= most).drop("_n")


def quality(average: Column, kept_: Column, total: Column) -> Column:
    share = kept_ / F.greatest(total, F.lit(1))
    none = (total == 0) | (kept_ == 0)
    return F.when(none, "low").when((average >= 0.75) & (share >= 0.35), "high").when((average >= 0.45) & (share >= 0.15), "medium").otherwise("low")


def summaries(items: DataFrame, fragments: DataFrame, contexts: DataFrame, most: int = MOST_ITEMS) -> DataFrame:
    """(item_id, quality, use_policy, kept_fragments, discarded_summary) of every item; without fragments: unavailable."""
    rows = scored(fragments, contexts)
    counts = rows.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("total"), F.avg(F.when(F.col("text") != "", F.col("confidence"))).alias("average"), F.count_if("isolated_numeric").alias("lone"),
        F.count_if("low_confidence").alias("doubtful"), F.count_if(F.col("score") < LEAST_SCORE).alias("noise"),
    )
    best = kept(rows, most).groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text", "role", "confidence", "reason"))), lambda x: F.struct(x["text"].alias("text"), x["role"].alias("role"), x["confidence"].alias("confidence"), x["reason"].alias("reason"))).alias("kept_fragments"))
    out = items.select("item_id").join(counts, "item_id", "left").join(best, "item_id", "left")
    n = F.coalesce(F.size("kept_fragments"), F.lit(0))
    q = F.when(F.col("total").isNull(), "unavailable").otherwise(quality(F.coalesce("average", F.lit(0.0)), F.when(F.col("kept_fragments").isNull(), 0).otherwise(n), F.col("total")))
    out = out.withColumn("quality", q)
    policy = F.when(F.col("quality") == "high", "use").when(F.col("quality") == "medium", "use_cautiously").otherwise("ignore")
    text = F.format_string("%d isolated numeric fragments, %d low-confidence fragments, %d noise/unaligned fragments ignored.", F.coalesce("lone", F.lit(0)), F.coalesce("doubtful", F.lit(0)), F.coalesce("noise", F.lit(0)))
    empty = F.array().cast("array<struct<text:string,role:string,confidence:double,reason:string>>")
    return out.select("item_id", "quality", policy.alias("use_policy"), F.coalesce("kept_fragments", empty).alias("kept_fragments"), F.when(F.col("total").isNull(), UNAVAILABLE).otherwise(text).alias("discarded_summary"))
