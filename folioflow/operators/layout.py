"""Page layout: captions, columns, and the regions of figures and tables. Boxes are structs x0, y0, x1, y1 in points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import stripped

# Thresholds in points, and the caption pattern.
PADDING, CROSS, WIDE, LABEL_MARGIN, LABEL_WIDTH, GAP, SLACK = 16.0, 50.0, 0.45, 60.0, 0.35, 30.0, 5.0
SMALL_AREA, SMALL_WIDTH, SMALL_HEIGHT, ROTATED, CAPTION_WIDTH, CAPTION_CHARS, CAPTION_SEARCH = 20_000.0, 180.0, 120.0, 2.5, 20.0, 500, 80.0
WHITE, LEAST_STRIP, DRAWN = 0.97, 10.0, 2.0
TABLE_CAPTION = r"(?i)^(Table|Tabla)\s+[\p{L}\p{N}_]"
CAPTION = r"(?i)^\s*(Figure|Fig\.?|Table|Extended\s+Data\s+Fig(?:ure|\.)?)\s*(\d+)"


def width(box: Column) -> Column:
    return box["x1"] - box["x0"]


def height(box: Column) -> Column:
    return box["y1"] - box["y0"]


def skip_reason(kind: Column, box: Column, caption: Column) -> Column:
    """Why an uncaptioned picture is taken for a logo or icon; empty if it is kept."""
    w, h = F.greatest(F.lit(0.0), width(box)), F.greatest(F.lit(0.0), height(box))
    free = (kind == "figure") & (stripped(F.coalesce(caption, F.lit(""))) == "")
    return F.when(free & (w * h <= SMALL_AREA), "small_uncaptioned").when(free & (w <= SMALL_WIDTH) & (h <= SMALL_HEIGHT), "compact_uncaptioned").otherwise("")


def column_of(box: Column, page_width: Column) -> Column:
    mid = page_width / 2
    return F.when((box["x1"] < mid + CROSS) & (box["x0"] < mid), "left").when((box["x0"] > mid - CROSS) & (box["x1"] > mid), "right").otherwise("full")


def in_column(box: Column, column: Column, page_width: Column) -> Column:
    mid = page_width / 2
    return F.when(column == "left", box["x1"] <= mid + CROSS).when(column == "right", box["x0"] >= mid - CROSS).otherwise(F.lit(True))


def is_rotated(box: Column) -> Column:
    return (width(box) > 0) & (height(box) > width(box) * ROTATED)


def clip_of(box: Column, page_width: Column, page_height: Column) -> Column:
    """A box with its origin at the page's lower left as a padded clip with the origin at the upper left."""
    return F.struct(
        F.greatest(F.lit(0.0), box["x0"] - PADDING).alias("x0"), F.greatest(F.lit(0.0), page_height - box["y1"] - PADDING).alias("y0"),
        F.least(page_width, box["x1"] + PADDING).alias("x1"), F.least(page_height, page_height - box["y0"] + PADDING).alias("y1"),
    )


def hull(page_width: Column, page_height: Column, box: str = "box") -> Column:
    """Aggregate: the padded box around boxes, within the page."""
    return F.struct(
        F.greatest(F.lit(0.0), F.min(f"{box}.x0") - PADDING).alias("x0"), F.greatest(F.lit(0.0), F.min(f"{box}.y0") - PADDING).alias("y0"),
        F.least(page_width, F.max(f"{box}.x1") + PADDING).alias("x1"), F.least(page_height, F.max(f"{box}.y1") + PADDING).alias("y1"),
    )


def joined_caption(parts: Column) -> Column:
    """The texts that a picture's captions consist of, as one."""
    return F.substring(F.array_join(F.filter(parts, lambda t: F.coalesce(t, F.lit("")) != ""), " "), 1, CAPTION_CHARS)


def visuals(blocks: DataFrame, drawings: DataFrame) -> DataFrame:
    """(paper_id, page, box) of image blocks, and of drawings that are more than a line."""
    b = F.col("box")
    drawn = drawings.filter((width(b) > DRAWN) & (height(b) > DRAWN))
    return blocks.filter("type = 1").select("paper_id", "page", "box").unionByName(drawn.select("paper_id", "page", "box"))


def captions(blocks: DataFrame) -> DataFrame:
    """(paper_id, page, pos, box, label, kind, caption) of text blocks (lines of spans) that begin like a caption."""
    lines = F.transform("lines", lambda line: F.array_join(line, ""))
    first = F.try_element_at(lines, F.lit(1))
    word, number = F.lower(F.regexp_extract(first, CAPTION, 1)), F.regexp_extract(first, CAPTION, 2)
    found = blocks.filter((F.col("type") == 0) & (F.size("lines") > 0) & first.rlike(CAPTION) & (width(F.col("box")) >= CAPTION_WIDTH))
    kind = F.when(word.contains("table"), "table").otherwise("figure")
    prefix = F.when(word.contains("table"), "Table ").when(word.contains("extended"), "ExtFig ").otherwise("Figure ")
    return found.select("paper_id", "page", "pos", "box", F.concat(prefix, number).alias("label"), kind.alias("kind"), F.substring(F.array_join(lines, " "), 1, CAPTION_CHARS).alias("caption"))


def with_boundary(caps: DataFrame, pages: DataFrame) -> DataFrame:
    """``caps`` with width, height, column and prev: the lowest edge of a caption above in the same column, or 0.

    A sweep down each column: tops and lower edges in one order (at the same height tops come first), and at each top the
    largest edge so far. A box that stands upside down is taken as if it were upright.
    """
    own = caps.join(pages, ["paper_id", "page"]).withColumn("column", column_of(F.col("box"), F.col("width")))
    names = own.columns
    top, edge = F.least("box.y0", "box.y1"), F.greatest("box.y0", "box.y1")
    # Only the row of a caption's top has its columns.
    row = F.struct(*names)
    ends = F.array(F.struct(top.alias("y"), F.lit(0).alias("kind"), row.alias("row")), F.struct(edge.alias("y"), F.lit(1).alias("kind"), F.when(F.lit(False), row).alias("row")))
    rows = own.select("paper_id", "page", "column", F.explode(ends).alias("_e")).select("paper_id", "page", "column", "_e.*")
    sweep = Window.partitionBy("paper_id", "page", "column").orderBy("y", "kind").rowsBetween(Window.unboundedPreceding, 0)
    above = F.max(F.when((F.col("kind") == 1) & (F.col("y") > 0), F.col("y"))).over(sweep)
    return rows.withColumn("prev", F.coalesce(above, F.lit(0.0))).filter("kind = 0").select("row.*", "prev")


def figure_regions(caps: DataFrame, visuals: DataFrame, texts: DataFrame) -> DataFrame:
    """(paper_id, page, pos, region) for captions that have pictures or drawings above them.

    ``caps`` come from ``with_boundary``; ``visuals`` and ``texts`` are (paper_id, page, box). All joins are equi
    joins on the page with the ranges as residue.
    """
    key = ["paper_id", "page"]
    cap = caps.select(*key, "pos", F.col("box").alias("cap"), "width", "height", "column", "prev")
    near = (F.col("box.y0") <= F.col("cap.y0") + SLACK) & (F.col("box.y1") >= F.col("prev") - SLACK)
    seen = cap.join(visuals.select(*key, "box"), key).filter(near)
    own = Window.partitionBy(*key, "pos")
    wide = F.max("box.x1").over(own) - F.min("box.x0").over(own) > F.col("width") * WIDE
    seen = seen.withColumn("column", F.when(wide, "full").otherwise(F.col("column"))).withColumn("_in", in_column(F.col("box"), F.col("column"), F.col("width")))
    kept = seen.withColumn("_any", F.max("_in").over(own)).filter(F.col("_in") | ~F.col("_any"))
    grouped = kept.groupBy(*key, "pos", "cap", "width", "height", "prev").agg(F.struct(F.min("box.x0").alias("x0"), F.min("box.y0").alias("y0"), F.max("box.x1").alias("x1"), F.max("box.y1").alias("y1")).alias("v"))
    m, b, v = LABEL_MARGIN, F.col("_b"), F.col("v")
    touches = (b["x1"] > v["x0"] - m) & (b["x0"] < v["x1"] + m) & (b["y1"] > v["y0"] - m) & (b["y0"] < v["y1"] + m)
    close = (b["y0"] <= F.col("cap.y0") + SLACK) & (b["y1"] >= F.col("prev") - SLACK) & (b != F.col("cap")) & (width(b) <= F.col("width") * LABEL_WIDTH)
    labels = texts.select(F.col("paper_id").alias("_p"), F.col("page").alias("_g"), F.col("box").alias("_b"))
    rows = grouped.join(labels, (F.col("paper_id") == F.col("_p")) & (F.col("page") == F.col("_g")) & close & touches, "left")
    both = rows.groupBy(*key, "pos", "width", "height", "v").agg(*[f(f"_b.{k}").alias(k) for f, k in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    region = F.struct(
        F.greatest(F.lit(0.0), F.least(v["x0"], "x0") - PADDING).alias("x0"), F.greatest(F.lit(0.0), F.least(v["y0"], "y0") - PADDING).alias("y0"),
        F.least(F.col("width"), F.greatest(v["x1"], "x1") + PADDING).alias("x1"), F.least(F.col("height"), F.greatest(v["y1"], "y1") + PADDING).alias("y1"),
    )
    return both.select(*key, "pos", region.alias("region"))


def table_regions(caps: DataFrame, texts: DataFrame, max_height: float = 9_999.0) -> DataFrame:
    """(paper_id, page, pos, region): text blocks above a table's caption, upwards until a gap of GAP points."""
    key = ["paper_id", "page"]
    cap = caps.select(*key, "pos", F.col("box").alias("cap"), "width", "height", "column", "prev")
    c, b = F.col("cap"), F.col("box")
    ok = (b["y1"] <= c["y0"] + SLACK) & (b["y0"] >= F.col("prev") - SLACK) & (c["y0"] - b["y1"] <= max_height) & (b != c) & in_column(b, F.col("column"), F.col("width"))
    rows = cap.join(texts.select(*key, "box", F.col("pos").alias("_b")), key).filter(ok)
    up = Window.partitionBy(*key, "pos").orderBy(F.desc("box.y1"), "_b")
    rows = rows.withColumn("_gap", F.coalesce(F.lag("box.y0").over(up) - F.col("box.y1") >= GAP, F.lit(False)).cast("int"))
    rows = rows.withColumn("_broken", F.sum("_gap").over(up)).filter("_broken = 0")
    return rows.groupBy(*key, "pos", "width", "height").agg(hull(F.col("width"), F.col("height")).alias("region")).select(*key, "pos", "region")


def next_page_captions(caps: DataFrame, pages: DataFrame) -> DataFrame:
    """For captions without a region: the same on the next page, as if above its first caption (or at its foot)."""
    lowest = caps.groupBy("paper_id", "page").agg(F.min("box.y0").alias("_first"))
    moved = caps.select("paper_id", (F.col("page") + 1).alias("page"), "pos", F.col("page").alias("caption_page"))
    out = moved.join(pages, ["paper_id", "page"]).join(lowest, ["paper_id", "page"], "left").withColumn("_y", F.coalesce("_first", "height"))
    box = F.struct(F.lit(0.0).alias("x0"), F.col("_y").alias("y0"), F.col("width").alias("x1"), F.col("_y").alias("y1"))
    return out.select("paper_id", "page", "pos", "caption_page", box.alias("box"), "width", "height", F.lit(0.0).alias("prev")).withColumn("column", column_of(F.col("box"), F.col("width")))


def regions(caps: DataFrame, pages: DataFrame, visuals: DataFrame, texts: DataFrame, strips: DataFrame | None = None) -> DataFrame:
    """``caps`` with region and render_page: from their own page, else the next page, else ``strips`` (a fallback)."""
    key = ["paper_id", "page", "pos"]
    full = with_boundary(caps, pages)
    figures = figure_regions(full.filter("kind = 'figure'"), visuals, texts)
    own = figures.unionByName(table_regions(full.filter("kind = 'table'"), texts))
    own = full.select(*key).join(own, key).withColumn("render_page", F.col("page"))
    rest = full.join(own, key, "left_anti")
    moved = next_page_captions(caps, pages).join(rest.select("paper_id", F.col("page").alias("caption_page"), "pos"), ["paper_id", "caption_page", "pos"], "left_semi")
    later = figure_regions(moved, visuals, texts).select("paper_id", (F.col("page") - 1).alias("page"), "pos", "region", F.col("page").alias("render_page"))
    found = own.unionByName(later)
    if strips is not None:
        found = found.unionByName(strips.join(found, key, "left_anti").select(*key, "region", F.col("page").alias("render_page")))
    return caps.join(found, key)


def strip_region(box: Column, column: Column, prev: Column, page_width: Column) -> Column:
    """The caption's column from the boundary above to the caption, for a blank test; null if it is too low."""
    mid, top = page_width / 2, F.greatest(F.lit(0.0), prev)
    x0, x1 = F.when(column == "right", mid).otherwise(F.lit(0.0)), F.when(column == "left", mid).otherwise(page_width)
    return F.when(box["y0"] - top >= LEAST_STRIP, F.struct(x0.alias("x0"), top.alias("y0"), x1.alias("x1"), box["y0"].alias("y1")))


def strips(caps: DataFrame) -> DataFrame:
    """(paper_id, page, pos, box): what is tested for being blank above captions of ``with_boundary``."""
    rows = caps.select("paper_id", "page", "pos", strip_region(F.col("box"), F.col("column"), F.col("prev"), F.col("width")).alias("box"))
    return rows.filter("box is not null")


def fallback_regions(caps: DataFrame, ratios: DataFrame) -> DataFrame:
    """(paper_id, page, pos, region): the padded strip above a caption of ``with_boundary``, if it isn't blank.

    ``ratios`` (paper_id, page, pos, ratio): the share of almost white pixels of the strips.
    """
    key, s = ["paper_id", "page", "pos"], F.col("_s")
    rows = caps.withColumn("_s", strip_region(F.col("box"), F.col("column"), F.col("prev"), F.col("width"))).join(ratios, key)
    rows = rows.filter(s.isNotNull() & (F.col("ratio") <= WHITE))
    region = F.struct(
        F.greatest(F.lit(0.0), s["x0"] - PADDING).alias("x0"), F.greatest(F.lit(0.0), s["y0"] - PADDING).alias("y0"),
        F.least(F.col("width"), s["x1"] + PADDING).alias("x1"), F.least(F.col("height"), s["y1"] + PADDING).alias("y1"),
    )
    return rows.select(*key, region.alias("region"))


def labelled_pictures(pictures: DataFrame) -> DataFrame:
    """``pictures`` (paper_id, pos, page, box, caption) that have a page, with reason (why skipped, or empty) and label.

    A caption's number makes the label. Of the others those that are kept get a running number, those that are
    skipped their place among all pictures, with those that have no page.
    """
    number = F.regexp_extract("caption", r"(?i)(?:Figure|Fig\.?)\s+(\d+)", 1)
    order = Window.partitionBy("paper_id").orderBy("pos")
    rows = pictures.withColumns({"_number": F.coalesce(number, F.lit("")), "_seen": F.row_number().over(order), "reason": skip_reason(F.lit("figure"), F.col("box"), F.col("caption"))})
    free = F.col("page").isNotNull() & (F.col("reason") == "") & (F.col("_number") == "")
    rows = rows.withColumn("_run", F.sum(free.cast("int")).over(order)).filter("page is not null")
    label = F.when(F.col("_number") != "", F.concat(F.lit("Figure "), "_number")).when(F.col("reason") != "", F.concat(F.lit("Picture_"), F.col("_seen").cast("string")))
    return rows.withColumn("label", label.otherwise(F.concat(F.lit("Figure_uncaptioned_"), F.col("_run").cast("string")))).drop("_number", "_seen", "_run")


def split_pictures(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pictures to keep, and the skipped ones with rounded box and size."""
    b = F.col("box")
    skipped = labelled.filter("reason <> ''").withColumns({
        "kind": F.lit("figure"), "bbox": F.array(*[F.bround(b[k], 1) for k in ("x0", "y0", "x1", "y1")]),
        "bbox_size": F.array(*[F.bround(F.greatest(F.lit(0.0), size), 0).cast("long") for size in (width(b), height(b))]),
    })
    return labelled.filter("reason = ''").drop("reason"), skipped.select("paper_id", "pos", "label", "kind", "page", "bbox", "caption", "reason", "bbox_size")


def labelled_tables(tables: DataFrame) -> DataFrame:
    """``tables`` (paper_id, pos, page, box, caption) that have a page, with label: the caption's number or word, else their place."""
    word = F.coalesce(F.regexp_extract("caption", r"(?i)Table\s+([\p{L}\p{N}_]+)", 1), F.lit(""))
    place = F.row_number().over(Window.partitionBy("paper_id").orderBy("pos"))
    rows = tables.filter("page is not null").withColumns({"_word": word, "_place": place})
    return rows.withColumn("label", F.when(F.col("_word") != "", F.concat(F.lit("Table "), "_word")).otherwise(F.concat(F.lit("Table_"), F.col("_place").cast("string")))).drop("_word", "_place")


def listed(pictures: DataFrame, tables: DataFrame) -> DataFrame:
    """Labelled pictures and tables together: paper_id, kind, pos, label, page, box, caption."""
    rows = None
    for kind, part in (("figure", pictures), ("table", tables)):
        part = part.select("paper_id", F.lit(kind).alias("kind"), "pos", "label", "page", "box", "caption")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def place() -> Column:
    """The place (from 1) of an item of ``listed`` in its paper's list: pictures and then tables."""
    return F.row_number().over(Window.partitionBy("paper_id").orderBy(F.col("kind") == "table", "pos"))


def figure_items(pictures: DataFrame, tables: DataFrame) -> DataFrame:
    """One list of labelled pictures and then tables: paper_id, place (from 1), kind, label, page, box, caption, file."""
    return listed(pictures, tables).withColumns({"place": place(), "file": image_name(F.col("page"), F.col("label"))}).drop("pos")


def image_name(page: Column, label: Column) -> Column:
    return F.concat(F.lit("p"), F.lpad(page.cast("string"), 3, "0"), F.lit("_"), F.replace(F.replace(label, F.lit(" "), F.lit("_")), F.lit("."), F.lit("")), F.lit(".png"))


def nearby_captions(tables: DataFrame, lines: DataFrame) -> DataFrame:
    """(paper_id, page, pos, caption): text in a zone above a table that has a caption line, else in one below."""
    key = ["paper_id", "page"]
    b, line = F.col("box"), F.col("_l")
    inside = (line["x1"] > b["x0"] - 20) & (line["x0"] < b["x1"] + 20)
    above = (line["y1"] > b["y0"] - CAPTION_SEARCH) & (line["y0"] < b["y0"])
    below = (line["y1"] > b["y1"]) & (line["y0"] < b["y1"] + CAPTION_SEARCH)
    rows = tables.select(*key, "pos", "box").join(lines.select(*key, F.col("pos").alias("_k"), F.col("box").alias("_l"), "text"), key)
    rows = rows.filter(inside).select(*key, "pos", "_k", stripped("text").alias("t"), F.array(F.when(above, 1), F.when(below, 2)).alias("_zones"))
    rows = rows.select(*key, "pos", "_k", "t", F.explode("_zones").alias("zone")).filter("zone is not null and t <> ''")
    zones = rows.groupBy(*key, "pos", "zone").agg(F.array_sort(F.collect_list(F.struct("_k", "t"))).alias("_t"), F.max(F.col("t").rlike(TABLE_CAPTION)).alias("_has")).filter("_has")
    first = zones.groupBy(*key, "pos").agg(F.min(F.struct("zone", "_t")).alias("_z"))
    return first.select(*key, "pos", F.substring(F.array_join(F.transform("_z._t", lambda x: x["t"]), " "), 1, CAPTION_CHARS).alias("caption"))
