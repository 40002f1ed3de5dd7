"""Paper tables: scans with defaults, joins, paging, resume; and the sinks of results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import stripped

from .lifecycle import scratch

PAPER_COLUMNS = ("pmcid", "doi", "title", "text_clean")


def require(df: DataFrame, *names: str) -> DataFrame:
    """``df``, or an error that lists the columns it lacks."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def clean(column: str | Column) -> Column:
    """Text without white space around it; null is empty."""
    c = F.col(column) if isinstance(column, str) else column
    return stripped(F.coalesce(c.cast("string"), F.lit("")))


def with_defaults(df: DataFrame) -> DataFrame:
    """PAPER_COLUMNS of ``df``, absent optional ones empty, all cleaned; other columns stay."""
    require(df, "pmcid")
    return df.withColumns({c: clean(c) if c in df.columns else F.lit("") for c in PAPER_COLUMNS})


def page(df: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows after ``offset``, ``limit`` of them (None or 0: all), in the order of a position column."""
    out = df.orderBy(order) if offset or limit else df
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit else out


def papers(df: DataFrame, order: str = "pos", offset: int = 0, limit: int | None = None) -> DataFrame:
    """Papers of one table: paged first, then those without pmcid go."""
    return with_defaults(page(df, order, offset, limit)).filter("pmcid <> ''")


def joined_papers(metadata: DataFrame, texts: DataFrame, order: str = "pos", offset: int = 0, limit: int | None = None) -> DataFrame:
    """Papers of two tables: every metadata row, with its text or an empty one."""
    require(texts, "pmcid", "text_clean")
    both = require(metadata, "pmcid").drop("text_clean").join(texts.select("pmcid", "text_clean"), "pmcid", "left")
    return papers(both, order, offset, limit)


def selected_papers(metadata: DataFrame, texts: DataFrame, field: str | None = None, quality_min: float = 0, order: str = "pos", offset: int = 0, limit: int = 0) -> DataFrame:
    """Papers that have a text, of one field (case ignored), of at least a quality (0: any), paged last."""
    both = require(metadata, "pmcid").join(texts.select("pmcid", "text_clean"), "pmcid")
    if field:
        both = both.filter(F.lower("main_field") == field.lower())
    if quality_min > 0:
        both = both.filter(F.col("quality_score") >= quality_min)
    return page(both, order, offset, limit)


def read_papers(spark: SparkSession, input_parquet: str | None = None, metadata_parquet: str | None = None, texts_parquet: str | None = None, **paging) -> DataFrame:
    """Papers from one file, which wins, or from metadata and texts, of which both are needed."""
    if input_parquet:
        return papers(spark.read.parquet(input_parquet), **paging)
    if not (metadata_parquet and texts_parquet):
        raise ValueError("give one input, or metadata and texts")
    return joined_papers(spark.read.parquet(metadata_parquet), spark.read.parquet(texts_parquet), **paging)


def not_done(todo: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """What resume has still to do: rows of ``todo`` whose keys aren't in ``done``."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def union_items(*items: DataFrame) -> DataFrame:
    """All items, columns matched by name, absent ones null."""
    out = items[0]
    for more in items[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def or_else(first: DataFrame, second: DataFrame, *keys: str) -> DataFrame:
    """``first``, and for keys that it lacks the rows of ``second``."""
    return union_items(first, not_done(second, first, *keys))


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once: written to the shared folder and read from there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def or_else_on_demand(wanted: DataFrame, first: DataFrame, second: Callable[[DataFrame], DataFrame], *keys: str) -> DataFrame:
    """``first``, and what ``second`` makes of the rows of ``wanted`` whose keys it lacks: nothing else is given to ``second``.

    ``first`` is computed once and stored, since both the result and what is lacking are read from it. What is lacking is
    stored too, so that a costly ``second`` never sees a row because a join is planned anew.
    """
    found = kept(first, "first")
    return union_items(found, second(kept(not_done(wanted, found, *keys), "lacking")))


def basename(column: str | Column) -> Column:
    return F.regexp_extract(column, r"[^/]*$", 0)


def normalised_items(items: DataFrame) -> DataFrame:
    """Items with defaults for what is absent, and the image's file name without its folder."""
    defaults = {"label": "''", "kind": "'figure'", "page": "0", "caption": "''", "image_path": "''"}
    out = items.withColumns({c: F.coalesce(F.col(c), F.expr(d)) if c in items.columns else F.expr(d) for c, d in defaults.items()})
    return out.withColumn("image_path", basename("image_path"))


def enveloped(items: DataFrame, paper: str, order: str, fields: list[str]) -> DataFrame:
    """One JSON document a paper: its number of items, and the items in order."""
    item = F.struct(*fields)
    rows = items.groupBy(paper).agg(F.count(F.lit(1)).alias("total"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), item.alias("_i")))).alias("_l"))
    return rows.select(paper, F.to_json(F.struct("total", F.transform("_l", lambda x: x["_i"]).alias("items"))).alias("document"))


def write_context(df: DataFrame, folder: str) -> None:
    """Metadata of every paper as JSON; texts, where there are any, as Parquet by hash bucket of the paper."""
    df.select("pmcid", "doi", "title").write.mode("overwrite").json(f"{folder}/context")
    df.filter("text_clean <> ''").select("pmcid", "text_clean").write.mode("overwrite").parquet(f"{folder}/texts")


def append_log(df: DataFrame, folder: str) -> None:
    df.write.mode("append").json(folder)


def items_of(documents: DataFrame) -> DataFrame:
    """Items of documents with an array ``items``, one row each, with their position."""
    return documents.select(F.posexplode("items").alias("pos", "_i")).select("pos", "_i.*")


def read_items(spark: SparkSession, figures: str, tables: str | None = None) -> DataFrame:
    """Items of JSON documents {..., items: [...]}: those of figures, then those of tables if that path is there."""
    from .lifecycle import exists

    read = lambda path, part: items_of(spark.read.option("multiLine", True).json(path)).withColumn("part", F.lit(part))
    first = read(figures, 0)
    return union_items(first, read(tables, 1)) if tables and exists(spark, tables) else first


def done_items(items: DataFrame) -> DataFrame:
    """Items that have an analysis already."""
    return items.filter("analysis is not null")


def done_papers(listing: DataFrame, *markers: str) -> DataFrame:
    """(pmcid) of the folders of a file listing (path) that hold all ``markers``."""
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    found = listing.select(folder.alias("pmcid"), basename("path").alias("_f")).filter(F.col("_f").isin(*markers))
    return found.groupBy("pmcid").agg(F.countDistinct("_f").alias("_n")).filter(F.col("_n") == len(set(markers))).select("pmcid")
