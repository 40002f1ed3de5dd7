"""What a run has done: counts of items, status of papers, analyses of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kind_counts(items: DataFrame, paper: str) -> DataFrame:
    """(paper, figures, tables): items of each kind; what isn't a table counts as a figure."""
    table = F.coalesce(F.col("kind"), F.lit("figure")) == "table"
    return items.groupBy(paper).agg(F.count_if(~table).alias("figures"), F.count_if(table).alias("tables"))


def paper_status(papers: DataFrame, figures: DataFrame, tables: DataFrame, failures: DataFrame, done: DataFrame) -> DataFrame:
    """(pmcid, doi, title, status, error, figures, tables, analysis) of every paper.

    ``figures`` and ``tables`` are items (pmcid), ``failures`` (pmcid, error) what went wrong, the first of which counts,
    and ``done`` (pmcid, analysis) the analyses. A failure never takes another paper with it.
    """
    count = lambda df, name: df.groupBy("pmcid").agg(F.count(F.lit(1)).alias(name))
    wrong = failures.filter("error is not null").groupBy("pmcid").agg(F.min("error").alias("error"))
    out = papers.select("pmcid", "doi", "title").join(count(figures, "figures"), "pmcid", "left").join(count(tables, "tables"), "pmcid", "left")
    out = out.join(wrong, "pmcid", "left").join(done.select("pmcid", "analysis"), "pmcid", "left")
    zero = F.lit(0).cast("long")
    return out.select("pmcid", "doi", "title", F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"), "error", F.coalesce("figures", zero).alias("figures"), F.coalesce("tables", zero).alias("tables"), "analysis")


def run_counts(analyses: DataFrame, run: str) -> DataFrame:
    """(run, analyses): how many analyses each run has."""
    return analyses.groupBy(run).agg(F.count(F.lit(1)).alias("analyses"))


def image_path(path: Column, folder: Column) -> Column:
    """Where an item's image is: as it says if that is absolute, else in the paper's folder under its file name."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(folder, F.lit("/"), F.regexp_extract(path, r"[^/]*$", 0)))
