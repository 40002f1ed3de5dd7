"""Prompts and answers: assembly, JSON salvage, confidence, synthesis blocks and status rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import stripped

# The keys of an answer.
FIGURE_KEYS = ("visual_description", "data_and_patterns", "scientific_conclusion", "limitations", "confidence")
TABLE_KEYS = ("table_description", "key_entries", "best_result", "scientific_interpretation", "confidence")
ANCHORED_KEYS = ("hypothesis_tested", "paper_quote", "controls_assessment")
SYNTHESIS_KEYS = ("main_contribution", "narrative", "key_evidence", "contradictions_or_gaps", "limitations_noted", "overall_confidence")
NOT_PROVIDED, NO_ABSTRACT = "Not provided.", "Not available."


def instructions(kind: Column, anchored: Column) -> Column:
    """What the model is asked for: keys by kind, and three more if there is a context to anchor them in."""
    asked = lambda keys: ", ".join(keys)
    keys = F.when(kind == "table", asked(TABLE_KEYS)).otherwise(asked(FIGURE_KEYS))
    more = F.when(anchored, F.concat(F.lit(", " + asked(ANCHORED_KEYS)))).otherwise("")
    return F.concat(F.lit("Describe only what the image and the text above support. Answer with one JSON object with the keys "), keys, more, F.lit("."))


def ocr_block(summary: Column) -> Column:
    """The kept fragments as JSON; empty if they are to be ignored."""
    use = (summary["use_policy"] != "ignore") & (F.size(summary["kept_fragments"]) > 0)
    return F.when(use, F.concat(F.lit("Filtered OCR fragments (auxiliary):\n"), F.to_json(summary), F.lit("\n\n"))).otherwise("")


def prompt(kind: Column, abstract: Column, caption: Column, context: Column, label: Column, summary: Column) -> Column:
    """Caption, context, OCR, abstract and instructions, in this order; null caption and empty abstract are named so."""
    text = F.coalesce(context, F.lit(""))
    anchored = stripped(text) != ""
    return F.concat(
        F.lit("Caption: "), F.coalesce(caption, F.lit(NOT_PROVIDED)), F.lit("\n\n"),
        F.when(anchored, F.concat(label, F.lit(":\n"), text, F.lit("\n\n"))).otherwise(""), F.coalesce(ocr_block(summary), F.lit("")),
        F.lit("Abstract: "), F.coalesce(F.nullif(abstract, F.lit("")), F.lit(NO_ABSTRACT)), F.lit("\n\n"), instructions(kind, anchored),
    )


def synthesis(abstract: Column, block: Column, items: Column) -> Column:
    """The question for a paper-level summary of ``items`` analyses."""
    ask = "\n\nSum up what these analyses show about the paper, and nothing else. Answer with one JSON object with the keys " + ", ".join(SYNTHESIS_KEYS) + "."
    return F.concat(F.lit("Abstract: "), F.coalesce(F.nullif(abstract, F.lit("")), F.lit(NO_ABSTRACT)), F.lit("\n\nAnalyses ("), items.cast("string"), F.lit("):\n"), block, F.lit(ask))


def image_url(image: Column) -> Column:
    """A PNG as a data URL."""
    return F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64(image), r"\s", ""))


def context_used(label: Column, context: Column) -> Column:
    named = F.lower(stripped(F.split(label, r"\(")[0]))
    return F.when(stripped(F.coalesce(context, F.lit(""))) != "", named).otherwise("abstract only")


def parsed(answer: str | Column) -> Column:
    """The JSON of an answer as a variant: as it is without fences, else from its first to its last brace; else null."""
    c = F.col(answer) if isinstance(answer, str) else answer
    opened = F.regexp_replace(stripped(c), r"^```(?:json)?", "")
    bare = stripped(F.when(opened.endswith("```"), F.substring(opened, F.lit(1), F.length(opened) - F.lit(3))).otherwise(opened))
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit(""))))


def confidence(variant: Column) -> Column:
    return F.coalesce(F.try_variant_get(variant, "$.confidence", "string"), F.lit("unknown"))


def first_key(variant: Column, *keys: str) -> Column:
    """The first of the keys that has a non-empty value, else empty."""
    return F.coalesce(*[F.nullif(F.try_variant_get(variant, f"$.{k}", "string"), F.lit("")) for k in keys], F.lit(""))


def item_line(label: Column, kind: Column, caption: Column, variant: Column) -> Column:
    return F.concat(
        F.lit("["), F.coalesce(label, F.lit("?")), F.lit("] ("), F.when(kind == "table", "Table").otherwise("Figure"), F.lit(") caption: "), F.substring(F.coalesce(caption, F.lit("")), 1, 120),
        F.lit("\n  finding: "), first_key(variant, "data_and_patterns", "key_entries", "best_result"), F.lit("\n  conclusion: "), first_key(variant, "scientific_conclusion", "scientific_interpretation"),
        F.lit("\n  confidence: "), confidence(variant),
    )


def joined_lines(df: DataFrame, group: str, order: list[str], line: Column, between: str = "\n\n") -> DataFrame:
    """(group, block, items): the group's lines in order."""
    rows = df.select(group, F.struct(*order, line.alias("_line")).alias("_r")).groupBy(group).agg(F.array_sort(F.collect_list("_r")).alias("_l"))
    return rows.select(group, F.array_join(F.transform("_l", lambda x: x["_line"]), between).alias("block"), F.size("_l").cast("long").alias("items"))


def bucket(status: Column) -> Column:
    """Run counters: ok, skip, or failed for all else."""
    return F.when(status.isin("ok", "skip"), status).otherwise("failed")


def matrix(models: DataFrame, modes: DataFrame) -> DataFrame:
    """Every model with every mode: two tables of configuration, a handful of rows each."""
    return models.crossJoin(F.broadcast(modes))
