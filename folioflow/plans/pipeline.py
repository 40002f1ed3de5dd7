"""Compositions: the context of items by mode, and the analysis of items by a model with resume and synthesis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import index, retrieval, text
from folioflow.sources import backends
from folioflow.sources.papers import not_done

from . import prompts

MODES = ("none", "bm25", "full", "layered")


def contexts(items: DataFrame, papers: DataFrame, mode: str = "bm25", top_k: int = retrieval.TOP_K, chunk_words: int = text.CHUNK_WORDS, overlap: int = text.OVERLAP, max_words: int = 0, made: index.Index | None = None) -> DataFrame:
    """(item_id, context, label, retrieved_chunks, retrieved_words) of ``items`` (item_id, paper, caption) by mode.

    ``papers`` are (paper, text). Mode none gives no context; full the text; bm25 the best chunks for the caption;
    layered the paper's map before them. ``made`` is the stored index of the papers' chunks (``index.build`` of
    ``text.chunk_rows`` with the same sizes), where there is one.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    zero = F.lit(0).cast("long")
    if mode == "none":
        return items.select("item_id", F.lit("").alias("context"), F.lit("abstract only").alias("label"), zero.alias("retrieved_chunks"), zero.alias("retrieved_words"))
    if mode == "full":
        whole = papers.select("paper", text.full_context("text", max_words).alias("_f"))
        rows = items.select("item_id", "paper").join(whole, "paper", "left")
        return rows.select("item_id", F.coalesce("_f.text", F.lit("")).alias("context"), F.concat(F.lit("Full paper text"), F.coalesce("_f.note", F.lit(""))).alias("label"), zero.alias("retrieved_chunks"), zero.alias("retrieved_words"))
    chunks = text.chunk_rows(papers, "paper", "text", size=chunk_words, overlap=overlap)
    queries = items.select("item_id", "paper", F.coalesce("caption", F.lit(prompts.NOT_PROVIDED)).alias("query"))
    best = retrieval.retrieve(queries, chunks, top_k) if made is None else retrieval.reordered(index.top_k(queries, made, top_k))
    local = retrieval.gathered(best, chunks)
    rows = items.select("item_id", "paper").join(local, "item_id", "left")
    context, label = F.coalesce("local", F.lit("")), f"Retrieved paper text (top {top_k} chunks)"
    if mode == "layered":
        rows = rows.join(text.with_context_map(papers.select("paper", "text"), "text", "_map").drop("text"), "paper", "left")
        context, label = retrieval.layered(F.col("_map"), F.col("local"), top_k), f"Layered paper context (map and top {top_k} chunks)"
    return rows.select("item_id", context.alias("context"), F.lit(label).alias("label"), F.coalesce("retrieved_chunks", zero).alias("retrieved_chunks"), F.coalesce("retrieved_words", zero).alias("retrieved_words"))


def analyse(items: DataFrame, papers: DataFrame, images: DataFrame, factory, summaries: DataFrame | None = None, done: DataFrame | None = None, mode: str = "bm25", **how) -> DataFrame:
    """Answers for items (item_id, paper, label, kind, caption) that aren't done; an item without image has an error.

    ``images`` are (item_id, image); ``factory`` makes a vision model per partition; ``summaries`` come from ocr.
    """
    todo = items if done is None else not_done(items, done, "paper", "label")
    ctx = contexts(todo, papers, mode, **how).drop("label")
    rows = todo.join(ctx, "item_id").join(papers.select("paper", text.abstract("text").alias("abstract")), "paper", "left").join(images, "item_id", "left")
    kind = "struct<quality:string,use_policy:string,kept_fragments:array<struct<text:string,role:string,confidence:double,reason:string>>,discarded_summary:string>"
    if summaries is not None:
        rows = rows.join(summaries.select("item_id", F.struct("quality", "use_policy", "kept_fragments", "discarded_summary").alias("summary")), "item_id", "left")
    else:
        rows = rows.withColumn("summary", F.lit(None).cast(kind))
    label = F.lit(f"Paper context ({mode})")
    rows = rows.withColumn("prompt", prompts.prompt(F.col("kind"), F.col("abstract"), F.col("caption"), F.col("context"), label, F.col("summary")))
    asked = backends.ask_model(rows.filter(F.col("image").isNotNull()), factory)
    out = items.join(rows.select("item_id", "retrieved_chunks", "retrieved_words", F.col("image").isNull().alias("_none")), "item_id").join(asked, "item_id", "left")
    parsed = prompts.parsed("answer")
    return out.withColumns({"analysis_parsed": parsed, "confidence": prompts.confidence(parsed), "context_strategy": F.lit(mode), "analysis_error": F.when(F.col("_none"), "image missing").otherwise(F.col("analysis_error"))}).drop("_none")


def synthesis_prompts(results: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """(paper, block, items, prompt): what a paper-level summary is asked about, from the items' analyses."""
    line = prompts.item_line(F.col("label"), F.col("kind"), F.col("caption"), F.col("analysis_parsed"))
    rows = prompts.joined_lines(results, "paper", ["item_id"], line)
    if papers is None:
        rows = rows.withColumn("_a", F.lit(""))
    else:
        rows = rows.join(papers.select("paper", text.abstract("text").alias("_a")), "paper", "left")
    return rows.withColumn("prompt", prompts.synthesis(F.col("_a"), F.col("block"), F.col("items"))).drop("_a")


def synthesise(results: DataFrame, papers: DataFrame, factory) -> DataFrame:
    """(paper, items, paper_summary, error): a paper-level summary by the model; a failure leaves it null."""
    rows = synthesis_prompts(results, papers)
    asked = backends.ask_model(rows.withColumn("image", F.lit(None).cast("binary")), factory, key="paper")
    out = rows.select("paper", "items").join(asked, "paper", "left")
    return out.select("paper", "items", F.when(F.col("answer").isNotNull(), summary_or_raw("answer")).alias("paper_summary"), F.col("analysis_error").alias("error"))


def summary_or_raw(answer: str) -> Column:
    """The synthesis answer as JSON, or {"raw": answer}."""
    return F.coalesce(prompts.parsed(answer), F.parse_json(F.to_json(F.struct(F.col(answer).alias("raw")))))
