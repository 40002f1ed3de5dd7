"""Table content: plausibility, continuation over pages, deduplication, labels and Markdown. Rows are array<array<string>>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import stripped
from folioflow.sources.papers import or_else

from . import layout

MIN_ROWS, MIN_COLUMNS, MIN_CELLS, MIN_AREA, MIN_ACCURACY = 2, 2, 6, 5_000.0, 50.0


def filled_cells(rows: Column) -> Column:
    return F.size(F.filter(F.flatten(rows), lambda c: stripped(F.coalesce(c, F.lit(""))) != ""))


def columns_of(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))


def plausible(rows: Column, area: Column, min_rows: int = MIN_ROWS, min_columns: int = MIN_COLUMNS, min_cells: int = MIN_CELLS) -> Column:
    return (F.size(rows) >= min_rows) & (columns_of(rows) >= min_columns) & (filled_cells(rows) >= min_cells) & (area >= MIN_AREA)


def continues(rows: Column) -> Column:
    """Whether the first row says that the table goes on from the one before."""
    first = F.filter(F.coalesce(F.try_element_at(rows, F.lit(1)), F.array().cast("array<string>")), lambda c: F.coalesce(c, F.lit("")) != "")
    return F.lower(F.array_join(first, " ")).contains("continued")


def cleaned(rows: Column) -> Column:
    return F.transform(rows, lambda r: F.transform(r, lambda c: stripped(F.coalesce(c, F.lit("")))))


def markdown(rows: Column) -> Column:
    """A Markdown table, the first row as its header; bars are escaped and line breaks become spaces."""
    cell = lambda c: stripped(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, cell), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.array_join(F.transform(rows[0], lambda c: F.lit("---")), "|"), F.lit("|"))
    body = F.transform(rows, line)
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(body, 1, 1), F.array(rule), F.slice(body, F.lit(2), F.greatest(F.size(rows) - F.lit(1), F.lit(0)))), "\n")).otherwise("")


def first_of_box(tables: DataFrame, *box: str) -> DataFrame:
    """Of detections on one page with the same box the first by pos."""
    order = Window.partitionBy("paper_id", "page", *box).orderBy("pos")
    return tables.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def merged(tables: DataFrame) -> DataFrame:
    """(paper_id, pos, page, pages, rows, and box if there is one): a table that continues the one before is joined to it,
    without its first row; place and box are those of the first."""
    order = Window.partitionBy("paper_id").orderBy("page", "pos")
    flagged = tables.withColumn("_more", continues(F.col("rows")) & (F.row_number().over(order) > 1))
    grouped = flagged.withColumn("_g", F.sum(F.when(F.col("_more"), 0).otherwise(1)).over(order))
    own = F.when(F.col("_more"), F.slice("rows", F.lit(2), F.greatest(F.size("rows") - F.lit(1), F.lit(0)))).otherwise(F.col("rows"))
    boxed = ["box"] if "box" in tables.columns else []
    parts = grouped.groupBy("paper_id", "_g").agg(F.array_sort(F.collect_list(F.struct("page", "pos", own.alias("rows"), *boxed))).alias("_p"))
    return parts.select("paper_id", *[F.col("_p")[0][c].alias(c) for c in ("pos", "page", *boxed)], F.transform("_p", lambda x: x["page"]).alias("pages"), F.flatten(F.transform("_p", lambda x: x["rows"])).alias("rows"))


def numbered(tables: DataFrame) -> DataFrame:
    """``tables`` with label Table_1, Table_2, ... in the order of each paper."""
    order = Window.partitionBy("paper_id").orderBy("page", "pos")
    return tables.withColumn("label", F.concat(F.lit("Table_"), F.row_number().over(order).cast("string")))


def accurate(tables: DataFrame, page_height: str = "height") -> DataFrame:
    """Detections of at least MIN_ACCURACY, their boxes turned to an origin at the upper left."""
    kept = tables.filter(F.col("accuracy") >= MIN_ACCURACY)
    h, b = F.col(page_height), F.col("box")
    return kept.withColumn("box", F.struct(b["x0"].alias("x0"), (h - b["y1"]).alias("y0"), b["x1"].alias("x1"), (h - b["y0"]).alias("y1")))


def finished(tables: DataFrame) -> DataFrame:
    """Merged tables with clean rows, counts and Markdown."""
    out = numbered(merged(tables)).withColumn("rows", cleaned(F.col("rows")))
    return out.withColumns({"row_count": F.size("rows"), "col_count": columns_of(F.col("rows")), "markdown": markdown(F.col("rows"))})


def detected(strict: DataFrame, default: DataFrame) -> DataFrame:
    """Detections (paper_id, page, pos, box, rows): the strict ones of a page, else its default ones; plausible, each box once.

    Boxes are rounded to a tenth of a point, and of equal ones on a page the first counts, before they are judged.
    """
    found = or_else(strict, default, "paper_id", "page")
    b = F.col("box")
    found = first_of_box(found.withColumn("box", F.struct(*[F.bround(b[k], 1).alias(k) for k in ("x0", "y0", "x1", "y1")])), "box")
    return found.filter(plausible(F.col("rows"), layout.width(b) * layout.height(b)))


def extracted(strict: DataFrame, default: DataFrame, lattice: DataFrame, pages: DataFrame, lines: DataFrame) -> DataFrame:
    """All tables of papers: label, page, pages, box, caption, rotated, clean rows, counts, Markdown, accuracy.

    ``strict`` and ``default`` detections are filtered and continued ones joined; a paper without any gets those of the
    second detector, ``lattice`` (also accuracy, boxes from the lower left). ``pages`` are (paper_id, page, width,
    height), ``lines`` (paper_id, page, pos, box, text) may hold captions.
    """
    main = merged(detected(strict, default))
    other = accurate(lattice.join(pages.select("paper_id", "page", "height"), ["paper_id", "page"])).drop("height")
    b = F.col("box")
    other = other.filter(plausible(F.col("rows"), layout.width(b) * layout.height(b))).withColumn("pages", F.array("page"))
    both = or_else(main, other, "paper_id")
    out = numbered(both).withColumns({"rotated": layout.is_rotated(b), "rows": cleaned(F.col("rows"))})
    out = out.withColumns({"row_count": F.size("rows"), "col_count": columns_of(F.col("rows")), "markdown": markdown(F.col("rows")), "file": layout.image_name(F.col("page"), F.col("label"))})
    captions = layout.nearby_captions(out, lines)
    return out.join(captions, ["paper_id", "page", "pos"], "left").withColumn("caption", F.coalesce("caption", F.lit("")))
