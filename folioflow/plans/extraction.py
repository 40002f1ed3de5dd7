"""Extraction of a paper's figures and tables, composed of layout and table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators import layout
from folioflow.sources.papers import kept, or_else_on_demand


def caption_items(blocks: DataFrame, drawings: DataFrame, pages: DataFrame, ratios: DataFrame | None = None) -> DataFrame:
    """Figures and tables found by their captions: paper_id, label, kind, page, render_page, box, caption, file.

    A caption's region lies on its own page, else at the next one's beginning, else it is the strip above it that
    ``ratios`` (paper_id, page, pos, ratio) shows not to be blank; a caption without any is dropped.
    """
    caps = layout.captions(blocks)
    seen, texts = layout.visuals(blocks, drawings), blocks.filter((F.col("type") == 0) & (F.size("lines") > 0)).select("paper_id", "page", "pos", "box")
    strips = None if ratios is None else layout.fallback_regions(layout.with_boundary(caps, pages), ratios)
    found = layout.regions(caps, pages, seen, texts, strips)
    return found.select("paper_id", "pos", "label", "kind", "page", "render_page", F.col("region").alias("box"), "caption", layout.image_name(F.col("page"), F.col("label")).alias("file"))


def figures(pictures: DataFrame, tables: DataFrame, blocks: DataFrame, drawings: DataFrame, pages: DataFrame, ratios: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Items of every paper, and the pictures that were skipped.

    A paper's items are the pictures and tables of its layout analysis (paper_id, pos, page, box, caption); of a paper of
    ``pages`` that has none of them, those that its captions show. Captions are looked for in those papers alone.
    """
    pics, skipped = layout.split_pictures(layout.labelled_pictures(pictures))

    def by_captions(lacking: DataFrame) -> DataFrame:
        own = lambda df, name: kept(df.join(lacking, "paper_id", "left_semi"), name)
        return caption_items(own(blocks, "blocks"), own(drawings, "drawings"), own(pages, "pages"), None if ratios is None else own(ratios, "ratios")).drop("file")

    # Only what can't be told from the rest is stored. A caption's item has a render_page and no place.
    out = or_else_on_demand(pages.select("paper_id").distinct(), layout.listed(pics, layout.labelled_tables(tables)), by_captions, "paper_id")
    first = F.col("render_page").isNull()
    out = out.withColumns({"place": F.when(first, layout.place()), "file": layout.image_name(F.col("page"), F.col("label"))})
    return out.withColumns({"pos": F.when(~first, F.col("pos")), "render_page": F.coalesce("render_page", "page")}), skipped
