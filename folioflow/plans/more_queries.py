"""Queries of extraction, runs and sinks over the driver's tables, each with its SQL; they join those of ``queries``."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions import index, retrieval, text
from folioflow.operators import layout, ocr, tables
from folioflow.sources import acquisition, lifecycle, papers

from . import extraction, pipeline, prompts, run
from .queries import _BM25, _BOXES, _COLUMN, _PARTS, _PICTURES, _ROWS, _SCORED, _TERMS, _USEFUL, _WORDS, _boxes, _contexts, _fragments, _library, _meta, _pages, _pictures, _rows, _sectioned, _stored_boxes, _unmarked, load, query

# --- layout -------------------------------------------------------------------------------------------------------


@query(_PICTURES + """SELECT paper, pos, label, page, reason, round(x0, 1) AS left_edge, CAST(greatest(0, x1 - x0) AS BIGINT) AS wide, CAST(greatest(0, y1 - y0) AS BIGINT) AS high FROM pics WHERE reason <> ''""")
def skipped_pictures(spark, d):
    _, skipped = layout.split_pictures(layout.labelled_pictures(_pictures(spark, d)))
    return skipped.select(F.col("paper_id").alias("paper"), "pos", "label", "page", "reason", F.col("bbox")[0].alias("left_edge"), F.col("bbox_size")[0].alias("wide"), F.col("bbox_size")[1].alias("high"))


_TABLES = _BOXES + """, u AS (SELECT paper, pos, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE pos END AS page, CASE WHEN l_partkey % 3 = 0 THEN 'TABLE  S' || l_partkey || ': x' WHEN l_partkey % 3 = 1 THEN 'no number' END AS caption,
  CASE WHEN l_partkey % 3 = 0 THEN 'Table S' || l_partkey END AS named FROM b),
tabs AS (SELECT *, coalesce(named, 'Table_' || row_number() OVER (PARTITION BY paper ORDER BY pos)) AS label FROM u WHERE page IS NOT NULL)
"""


def _layout_tables(spark, d, boxes=None):
    k = F.col("l_partkey") % 3
    caption = F.when(k == 0, F.concat(F.lit("TABLE  S"), F.col("l_partkey"), F.lit(": x"))).when(k == 1, "no number")
    boxes = _boxes(spark, d) if boxes is None else boxes
    return boxes.withColumns({"caption": caption, "page": F.when(F.col("l_partkey") % 9 != 0, F.col("pos"))})


@query(_TABLES + "SELECT paper, pos, label FROM tabs")
def table_labels(spark, d):
    return layout.labelled_tables(_layout_tables(spark, d)).select(F.col("paper_id").alias("paper"), "pos", "label")


@query(_PICTURES + _TABLES.removeprefix(_BOXES) + """SELECT paper, kind, label, page, CAST(row_number() OVER (PARTITION BY paper ORDER BY kind, pos) AS INTEGER) AS place FROM (
  SELECT paper, 'figure' AS kind, label, page, pos FROM pics WHERE reason = '' UNION ALL SELECT paper, 'table', label, page, pos FROM tabs)""")
def figure_items(spark, d):
    kept, _ = layout.split_pictures(layout.labelled_pictures(_pictures(spark, d)))
    out = layout.figure_items(kept, layout.labelled_tables(_layout_tables(spark, d)))
    return out.select(F.col("paper_id").alias("paper"), "kind", "label", "page", "place")


@query(_BOXES + """SELECT paper, x0, y0, x1, y1 FROM b WHERE l_partkey % 3 = 0
UNION ALL SELECT paper, x0, y0, x0 + l_partkey % 5, y0 + l_partkey % 4 FROM b WHERE l_partkey % 5 > 2 AND l_partkey % 4 > 2""")
def visuals_union(spark, d):
    b = _boxes(spark, d)
    blocks = b.withColumn("type", F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(0))
    box = F.struct(F.col("box.x0").alias("x0"), F.col("box.y0").alias("y0"), (F.col("box.x0") + F.col("l_partkey") % 5).alias("x1"), (F.col("box.y0") + F.col("l_partkey") % 4).alias("y1"))
    return layout.visuals(blocks, b.withColumn("box", box)).select(F.col("paper_id").alias("paper"), "box.*")


# Each block of an order is a page of its own: captions on some, pictures on others.
_STRIP = f"""CASE {_COLUMN} WHEN 'left' THEN 0 WHEN 'right' THEN 306 - 16 ELSE 0 END AS x0, 0 AS y0, CASE {_COLUMN} WHEN 'left' THEN 306 + 16 ELSE 612 END AS x1, least(792, y0 + 16) AS y1"""


def _cascade(spark, d):
    b = _boxes(spark, d).withColumns({"page": F.col("pos"), "pos": F.lit(0), "kind": F.lit("figure")})
    caps = b.filter(F.col("l_partkey") % 2 == 0)
    ratios = caps.select("paper_id", "page", "pos", ((F.col("l_partkey") % 100).cast("double") / 100).alias("ratio"))
    return b, caps, layout.fallback_regions(layout.with_boundary(caps.drop("l_partkey"), _pages(b)), ratios)


@query(_BOXES + f"""SELECT paper, page, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1 FROM (
  SELECT paper, pos AS page, {_STRIP} FROM b WHERE l_partkey % 2 = 0 AND b.y0 >= 10 AND l_partkey % 100 <= 97)""")
def fallback_region(spark, d):
    _, _, strips = _cascade(spark, d)
    return strips.select(F.col("paper_id").alias("paper"), "page", "region.*")


@query(_BOXES + f""", c AS (SELECT * FROM b WHERE l_partkey % 2 = 0), v AS (SELECT * FROM b WHERE l_partkey % 3 = 0),
own AS (SELECT c.paper, c.pos AS page, c.pos AS render_page, greatest(0, v.x0 - 16) AS x0, greatest(0, v.y0 - 16) AS y0, least(612, v.x1 + 16) AS x1, least(792, v.y1 + 16) AS y1 FROM c JOIN v ON v.paper = c.paper AND v.pos = c.pos),
later AS (SELECT c.paper, c.pos AS page, c.pos + 1 AS render_page, greatest(0, v.x0 - 16) AS x0, greatest(0, v.y0 - 16) AS y0, least(612, v.x1 + 16) AS x1, least(792, v.y1 + 16) AS y1 FROM c JOIN v ON v.paper = c.paper AND v.pos = c.pos + 1
  WHERE (c.paper, c.pos) NOT IN (SELECT (paper, page) FROM own) AND v.y0 <= CASE WHEN v.l_partkey % 2 = 0 THEN v.y0 ELSE 792 END + 5),
found AS (SELECT * FROM own UNION ALL SELECT * FROM later),
rest AS (SELECT paper, pos AS page, pos AS render_page, {_STRIP} FROM b WHERE l_partkey % 2 = 0 AND b.y0 >= 10 AND l_partkey % 100 <= 97 AND (paper, pos) NOT IN (SELECT (paper, page) FROM found))
SELECT paper, page, CAST(render_page AS INTEGER) AS render_page, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1 FROM (SELECT * FROM found UNION ALL SELECT * FROM rest)""")
def region_cascade(spark, d):
    b, caps, strips = _cascade(spark, d)
    none = b.limit(0).select("paper_id", "page", "pos", "box")
    out = layout.regions(caps.drop("l_partkey"), _pages(b), b.filter(F.col("l_partkey") % 3 == 0), none, strips)
    return out.select(F.col("paper_id").alias("paper"), "page", F.col("render_page").cast("int").alias("render_page"), "region.*")


# The first block of an order is a table, the others are lines of text, some of which begin like a caption.
@query(_BOXES + """, t AS (SELECT * FROM b WHERE pos = 1), l AS (SELECT paper, pos, x0, y0, x1, y1, CASE l_partkey % 3 WHEN 0 THEN 'Tabla ' || l_partkey WHEN 1 THEN 'words ' || pos ELSE ' ' END AS w FROM b WHERE pos > 1),
z AS (SELECT t.paper, l.pos, trim(w) AS w, unnest([CASE WHEN l.y1 > t.y0 - 80 AND l.y0 < t.y0 THEN 1 END, CASE WHEN l.y1 > t.y1 AND l.y0 < t.y1 + 80 THEN 2 END]) AS zone
  FROM t JOIN l ON l.paper = t.paper AND l.x1 > t.x0 - 20 AND l.x0 < t.x1 + 20),
g AS (SELECT paper, zone, string_agg(w, ' ' ORDER BY pos) AS caption, bool_or(regexp_matches(w, '^Tabla \\d')) AS has FROM z WHERE zone IS NOT NULL AND w <> '' GROUP BY ALL)
SELECT paper, arg_min(substr(caption, 1, 500), zone) AS caption FROM g WHERE has GROUP BY paper""".replace("\\\\d", "\\d"))
def table_captions(spark, d):
    b, k = _boxes(spark, d), F.col("l_partkey") % 3
    lines = b.filter("pos > 1").withColumn("text", F.when(k == 0, F.concat(F.lit("Tabla "), F.col("l_partkey"))).when(k == 1, F.concat(F.lit("\twords "), F.col("pos"))).otherwise(" "))
    return layout.nearby_captions(b.filter("pos = 1"), lines).select(F.col("paper_id").alias("paper"), "caption")


# --- tables -------------------------------------------------------------------------------------------------------

# A document is what the detectors found on a page; the strict one finds every fourth, the other may find a box twice.
_FOUND = f"""WITH d AS (SELECT doc_id, doc_id % 100 AS paper, doc_id // 100 AS page, n_chars, lang, {_ROWS.format("text")} AS r FROM documents),
f AS (SELECT paper, page, 0 AS pos, CAST(n_chars AS DOUBLE) AS wide, r FROM d UNION ALL SELECT paper, page, 1, CAST(CASE WHEN lang = 'en' THEN n_chars ELSE n_chars + 1 END AS DOUBLE), r FROM d WHERE doc_id % 4 <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY paper, page, wide ORDER BY pos) AS n FROM f),
ok AS (SELECT * FROM o WHERE n = 1 AND len(r) >= 2 AND list_max(list_transform(r, lambda x: len(x))) >= 2 AND len(list_filter(flatten(r), lambda x: trim(x) <> '')) >= 6 AND wide * 10 >= 5000)
"""


def _found(spark, d, pos, more):
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("n_chars") + more).cast("double").alias("x1"), F.lit(10.0).alias("y1"))
    return load(spark, d, "documents").select("doc_id", "lang", (F.col("doc_id") % 100).cast("string").alias("paper_id"), F.floor(F.col("doc_id") / 100).cast("int").alias("page"), F.lit(pos).alias("pos"), box.alias("box"), _rows().alias("rows"))


@query(_FOUND + "SELECT CAST(paper AS VARCHAR) AS paper, CAST(page AS INTEGER) AS page, pos, CAST(len(r) AS INTEGER) AS n_rows FROM ok")
def table_detect(spark, d):
    strict = _found(spark, d, 0, F.lit(0)).filter("doc_id % 4 = 0").drop("doc_id", "lang")
    default = _found(spark, d, 0, F.lit(0)).unionByName(_found(spark, d, 1, F.when(F.col("lang") == "en", 0).otherwise(1))).drop("doc_id", "lang")
    return tables.detected(strict, default).select(F.col("paper_id").alias("paper"), "page", "pos", F.size("rows").alias("n_rows"))


@query(f"""WITH l AS (SELECT l_orderkey AS paper, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount FROM lineitem)
SELECT paper, l_partkey, l_suppkey, 792.0 - (l_suppkey + l_quantity) AS y0, 792.0 - l_suppkey AS y1 FROM l WHERE l_discount * 1000 >= 50""")
def accurate_tables(spark, d):
    box = F.struct(F.lit(0.0).alias("x0"), F.col("l_suppkey").cast("double").alias("y0"), F.lit(9.0).alias("x1"), (F.col("l_suppkey") + F.col("l_quantity")).cast("double").alias("y1"))
    rows = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper"), "l_partkey", "l_suppkey", box.alias("box"), (F.col("l_discount") * 1000).alias("accuracy"), F.lit(792.0).alias("height"))
    return tables.accurate(rows).select("paper", "l_partkey", "l_suppkey", "box.y0", "box.y1")


@query(f"""SELECT doc_id, md5(array_to_string(list_transform(r, lambda x: array_to_string(list_transform(x, lambda y: regexp_replace(y, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')), '|')), '/')) AS digest FROM (SELECT doc_id, {_ROWS.format("text")} AS r FROM documents)""")
def table_cells(spark, d):
    wide = F.transform(_rows(), lambda r: F.transform(r, lambda c: F.concat(F.lit("\t 　"), c, F.lit("\n"))))
    clean = F.transform(tables.cleaned(wide), lambda r: F.array_join(r, "|"))
    return load(spark, d, "documents").select("doc_id", F.md5(F.array_join(clean, "/").cast("binary")).alias("digest"))


# --- sources, sinks and runs --------------------------------------------------------------------------------------


@query("""SELECT 'PMC' || doc_id AS pmcid FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages WHERE page_id % 3 > 0)""")
def pdf_reuse(spark, d):
    listing = load(spark, d, "pages").select(F.concat(F.lit("file:/pdf/PMC"), F.col("page_id"), F.lit(".pdf")).alias("path"), (F.col("page_id") % 3).alias("length"))
    return acquisition.missing_pdfs(_meta(spark, d), listing).select("pmcid")


@query("""SELECT 'PMC' || page_id AS pmcid FROM pages WHERE page_id % 2 = 0 AND page_id % 3 = 0""")
def done_markers(spark, d):
    path = lambda name: F.concat(F.lit("file:/out/PMC"), F.col("page_id"), F.lit(f"/{name}"))
    p = load(spark, d, "pages")
    listing = p.filter("page_id % 2 = 0").select(path("figures.json").alias("path")).union(p.filter("page_id % 3 = 0").select(path("tables.json"))).union(p.select(path("paper.pdf")))
    return papers.done_papers(listing, "figures.json", "tables.json")


@query("""SELECT page_id, coalesce(CASE WHEN page_id % 2 = 0 THEN 'L' || page_id END, '') AS label, 'figure' AS kind, 0 AS page, '' AS caption, regexp_extract(url, '[^/]*$') AS image_path FROM pages""")
def normalised_items(spark, d):
    rows = load(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("L"), F.col("page_id"))).alias("label"), F.col("url").alias("image_path"))
    return papers.normalised_items(rows).select("page_id", "label", "kind", "page", "caption", "image_path")


@query("""SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, turn, role FROM conversations""")
def json_items(spark, d):
    docs = papers.enveloped(load(spark, d, "conversations"), "conv_id", "turn", ["turn", "role"])
    parsed = docs.select("conv_id", F.from_json("document", "items array<struct<turn:long,role:string>>").alias("_d"))
    items = parsed.select("conv_id", F.transform("_d.items", lambda x: F.struct(F.col("conv_id").alias("conv_id"), x["turn"].alias("turn"), x["role"].alias("role"))).alias("items"))
    return papers.items_of(items).select("conv_id", "pos", "turn", "role")


@query("""SELECT conv_id, CAST(count(*) FILTER (role <> 'assistant') AS BIGINT) AS figures, CAST(count(*) FILTER (role = 'assistant') AS BIGINT) AS tables FROM conversations GROUP BY conv_id""")
def kind_counts(spark, d):
    items = load(spark, d, "conversations").withColumn("kind", F.when(F.col("role") == "assistant", "table"))
    return run.kind_counts(items, "conv_id")


@query("""SELECT 'PMC' || doc_id AS pmcid, lang AS title, CASE WHEN l.quality = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN l.quality = 0 THEN 'a ' || doc_id END AS error,
  coalesce(f.n, 0) AS figures, CAST(coalesce(f.n, 0) - coalesce(f.own, 0) AS BIGINT) AS tables, CASE WHEN l.toxic = 1 THEN 'analysis.json' END AS analysis
FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT conv_id AS doc_id, count(*) AS n, count(*) FILTER (role = 'user') AS own FROM conversations GROUP BY 1) f USING (doc_id)""")
def paper_status(spark, d):
    pmc = lambda c: F.concat(F.lit("PMC"), F.col(c)).alias("pmcid")
    figures = load(spark, d, "conversations").select(pmc("conv_id"), "role")
    bad = load(spark, d, "labels").filter("quality = 0")
    failures = bad.select(pmc("doc_id"), F.concat(F.lit("b "), F.col("doc_id")).alias("error")).union(bad.select(pmc("doc_id"), F.concat(F.lit("a "), F.col("doc_id"))))
    done = load(spark, d, "labels").filter("toxic = 1").select(pmc("doc_id"), F.lit("analysis.json").alias("analysis"))
    out = run.paper_status(_meta(spark, d), figures, figures.filter("role <> 'user'"), failures, done)
    return out.select("pmcid", "title", "status", "error", "figures", "tables", "analysis")


@query("""SELECT source || '/' || lang AS run, count(*) AS analyses FROM documents GROUP BY 1""")
def run_counts(spark, d):
    return run.run_counts(load(spark, d, "documents").select(F.concat_ws("/", "source", "lang").alias("run")), "run")


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/abs/' || page_id || '.png' ELSE '/out/P1/' || regexp_extract(url, '[^/]*$') END AS path, 'data:image/png;base64,' || to_base64(encode(html)) AS image FROM pages""")
def image_urls(spark, d):
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/abs/"), F.col("page_id"), F.lit(".png"))).otherwise(F.col("url"))
    return load(spark, d, "pages").select("page_id", run.image_path(path, F.lit("/out/P1")).alias("path"), prompts.image_url(F.col("html").cast("binary")).alias("image"))


# --- contexts and synthesis ---------------------------------------------------------------------------------------


@query("""SELECT CAST(conv_id AS VARCHAR) AS paper, string_agg('[Page ' || turn || ']' || chr(10) || regexp_replace(text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), chr(10) || chr(10) ORDER BY turn) AS text FROM conversations WHERE regexp_replace(text, '^[\\s\\p{Z}]+', '') <> '' GROUP BY conv_id""")
def paper_text(spark, d):
    pages = load(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("paper_id"), F.col("turn").alias("page"), "text")
    return text.joined_pages(pages).select(F.col("paper_id").alias("paper"), "text")


@query(rf"""SELECT doc_id, CASE WHEN regexp_matches(text, '[^\s\p{{Z}}]') THEN 'PAPER ABSTRACT:' || chr(10) || array_to_string(w[1:400], ' ') || chr(10) || chr(10) ELSE '' END AS block FROM (SELECT doc_id, text, {_WORDS.format("text")} AS w FROM documents)""")
def abstract_blocks(spark, d):
    return load(spark, d, "documents").select("doc_id", text.abstract_block("text").alias("block"))


@query("""SELECT item_id, doc_id AS chunk_ix, CAST(r AS INTEGER) AS rank FROM benchmark CROSS JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM documents QUALIFY r <= 4)""")
def empty_query_topk(spark, d):
    queries = load(spark, d, "benchmark").select("item_id", F.lit("all").alias("paper"), F.lit(" !? ").alias("query"))
    chunks = load(spark, d, "documents").select(F.lit("all").alias("paper"), F.col("doc_id").alias("chunk_ix"), "text")
    return retrieval.top_k(queries, chunks, retrieval.bm25(queries, chunks), 4).select("item_id", "chunk_ix", "rank")


@query(rf"""WITH w AS (SELECT item_id, len(dw) AS n, dw FROM (SELECT b.item_id, {_WORDS.format("d.text")} AS dw FROM benchmark b JOIN documents d ON d.doc_id = b.item_id))
SELECT item_id, 'none' AS mode, md5('') AS digest, 'abstract only' AS label FROM benchmark
UNION ALL SELECT item_id, 'full', md5(array_to_string(dw, ' ')), 'Full paper text [' || n || ' words]' FROM w
UNION ALL SELECT item_id, 'cut', md5(array_to_string(dw[1:50], ' ')), 'Full paper text' || CASE WHEN n > 50 THEN ' [truncated at 50 words, original: ' || n || ']' ELSE ' [' || n || ' words]' END FROM w""")
def context_modes(spark, d):
    items = load(spark, d, "benchmark").select("item_id", F.col("item_id").cast("string").alias("paper"), F.col("text").alias("caption"))
    docs = load(spark, d, "documents").select(F.col("doc_id").cast("string").alias("paper"), "text")
    out = None
    for name, mode, most in (("none", "none", 0), ("full", "full", 0), ("cut", "full", 50)):
        rows = pipeline.contexts(items, docs, mode, max_words=most).select("item_id", F.lit(name).alias("mode"), F.md5(F.col("context").cast("binary")).alias("digest"), "label")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""SELECT conv_id, md5('Abstract: ' || coalesce(nullif(a, ''), 'Not available.') || chr(10) || chr(10) || 'Analyses (' || n || '):' || chr(10) || block || chr(10) || chr(10) ||
  'Sum up what these analyses show about the paper, and nothing else. Answer with one JSON object with the keys main_contribution, narrative, key_evidence, contradictions_or_gaps, limitations_noted, overall_confidence.') AS digest
FROM (SELECT c.conv_id, min(d.a) AS a, count(*) AS n, string_agg('[' || turn || '] (Figure) caption: ' || substr(text, 1, 120) || chr(10) || '  finding: ' || role || chr(10) || '  conclusion: ' || chr(10) || '  confidence: unknown', chr(10) || chr(10) ORDER BY turn) AS block
  FROM conversations c LEFT JOIN (SELECT doc_id AS conv_id, array_to_string(_W_[1:400], ' ') AS a FROM documents) d USING (conv_id) GROUP BY c.conv_id)""".replace("_W_", _WORDS.format("text")))
def synthesis_prompt(spark, d):
    v = F.parse_json(F.concat(F.lit('{"data_and_patterns": "'), F.col("role"), F.lit('"}')))
    rows = load(spark, d, "conversations").select(F.col("conv_id").alias("paper"), F.col("turn").alias("item_id"), F.col("turn").cast("string").alias("label"), F.lit("figure").alias("kind"), F.col("text").alias("caption"), v.alias("analysis_parsed"))
    out = pipeline.synthesis_prompts(rows, load(spark, d, "documents").select(F.col("doc_id").alias("paper"), "text"))
    return out.select(F.col("paper").alias("conv_id"), F.md5(F.col("prompt").cast("binary")).alias("digest"))


# --- wholes: a paper's tables, its figures, the contexts of its items, the index ------------------------------------

_STRIPPED = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


# Every fifth paper has no tables but those of the second detector, which finds some in other papers too.
@query(_FOUND + f""", main AS (SELECT paper, page, pos, r, true AS captioned FROM ok WHERE paper % 5 <> 0),
other AS (SELECT paper, page, 0 AS pos, r, false FROM d WHERE paper % 5 <= 1 AND doc_id * 37 % 100 >= 50 AND len(r) >= 2 AND list_max(list_transform(r, lambda x: len(x))) >= 2
  AND len(list_filter(flatten(r), lambda x: trim(x) <> '')) >= 6 AND n_chars * 10 >= 5000 AND paper NOT IN (SELECT paper FROM main)),
every AS (SELECT *, row_number() OVER (PARTITION BY paper ORDER BY page, pos) AS n, list_transform(r, lambda x: list_transform(x, lambda y: {_STRIPPED.format("y")})) AS c FROM (SELECT * FROM main UNION ALL SELECT * FROM other)),
shown AS (SELECT *, list_transform(c, lambda x: list_transform(x, lambda y: {_STRIPPED.format("replace(y, '|', chr(92) || '|')")})) AS m FROM every)
SELECT CAST(e.paper AS VARCHAR) AS paper, CAST(e.page AS INTEGER) AS page, 'Table_' || e.n AS label, CAST(len(c) AS INTEGER) AS n_rows, CAST(list_max(list_transform(c, lambda x: len(x))) AS INTEGER) AS n_cols,
  md5(array_to_string(list_concat(['| ' || array_to_string(m[1], ' | ') || ' |', '|' || array_to_string(list_transform(m[1], lambda x: '---'), '|') || '|'], list_transform(m[2:], lambda x: '| ' || array_to_string(x, ' | ') || ' |')), chr(10))) AS digest,
  CASE WHEN captioned AND lang = 'en' THEN 'Table ' || doc_id || ': words' ELSE '' END AS caption, 'p' || lpad(CAST(e.page AS VARCHAR), 3, '0') || '_Table_' || e.n || '.png' AS file
FROM shown e JOIN d ON d.paper = e.paper AND d.page = e.page""")
def extract_tables(spark, d):
    main = F.col("doc_id") % 5 != 0
    strict = _found(spark, d, 0, F.lit(0)).filter((F.col("doc_id") % 4 == 0) & main).drop("doc_id", "lang")
    default = _found(spark, d, 0, F.lit(0)).unionByName(_found(spark, d, 1, F.when(F.col("lang") == "en", 0).otherwise(1))).filter(main).drop("doc_id", "lang")
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(100.0).alias("y0"), F.col("box.x1").alias("x1"), F.lit(110.0).alias("y1"))
    lattice = _found(spark, d, 0, F.lit(0)).filter("doc_id % 5 <= 1").withColumns({"box": box, "accuracy": (F.col("doc_id") * 37 % 100).cast("double")}).drop("doc_id", "lang")
    every = _found(spark, d, 5, F.lit(0))
    below = F.struct(*[F.lit(v).alias(k) for k, v in (("x0", 0.0), ("y0", 20.0), ("x1", 9.0), ("y1", 30.0))])
    lines = every.filter("lang = 'en'").select("paper_id", "page", "pos", below.alias("box"), F.concat(F.lit("Table "), F.col("doc_id"), F.lit(": words ")).alias("text"))
    out = tables.extracted(strict, default, lattice, _pages(every), lines)
    return out.select(F.col("paper_id").alias("paper"), "page", "label", F.col("row_count").alias("n_rows"), F.col("col_count").alias("n_cols"), F.md5(F.col("markdown").cast("binary")).alias("digest"), "caption", "file")


# Every fourth paper has no layout analysis: each block is a page of its own, a caption or an image.
@query(_PICTURES + _TABLES.removeprefix(_BOXES) + f""", first AS (
  SELECT paper, 'figure' AS kind, label, page, page AS render_page, x0, y0, x1, y1 FROM pics WHERE reason = '' AND paper % 4 <> 0
  UNION ALL SELECT t.paper, 'table', t.label, t.page, t.page, b.x0, b.y0, b.x1, b.y1 FROM tabs t JOIN b ON b.paper = t.paper AND b.pos = t.pos WHERE t.paper % 4 <> 0),
c AS (SELECT * FROM b WHERE l_partkey % 2 = 0 AND x1 - x0 >= 20 AND paper NOT IN (SELECT paper FROM first)), v AS (SELECT * FROM b WHERE l_partkey % 2 = 1),
later AS (SELECT c.paper, c.pos AS page, c.pos + 1 AS render_page, c.l_partkey, greatest(0, v.x0 - 16) AS x0, greatest(0, v.y0 - 16) AS y0, least(612, v.x1 + 16) AS x1, least(792, v.y1 + 16) AS y1 FROM c JOIN v ON v.paper = c.paper AND v.pos = c.pos + 1),
rest AS (SELECT paper, pos AS page, pos AS render_page, l_partkey, {_STRIP} FROM c WHERE y0 >= 10 AND l_partkey % 100 <= 97 AND (paper, pos) NOT IN (SELECT (paper, page) FROM later)),
every AS (SELECT * FROM first UNION ALL SELECT paper, 'figure', 'Figure ' || l_partkey, page, render_page, x0, y0, x1, y1 FROM (SELECT * FROM later UNION ALL SELECT * FROM rest))
SELECT paper, kind, label, CAST(page AS INTEGER) AS page, CAST(render_page AS INTEGER) AS render_page, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
  'p' || lpad(CAST(page AS VARCHAR), 3, '0') || '_' || replace(replace(label, ' ', '_'), '.', '') || '.png' AS file FROM every""")
def extract_figures(spark, d):
    analysed = F.col("paper_id") % 4 != 0
    boxes = _stored_boxes(spark, d)
    b = boxes.withColumns({"page": F.col("pos"), "pos": F.lit(0)})
    caption = F.col("l_partkey") % 2 == 0
    lines = F.array(F.array(F.concat(F.lit("Figure "), F.col("l_partkey"), F.lit(". words"))))
    blocks = b.select("paper_id", "page", "pos", "box", F.when(caption, 0).otherwise(1).alias("type"), F.when(caption, lines).otherwise(F.array().cast("array<array<string>>")).alias("lines"))
    ratios = b.select("paper_id", "page", "pos", ((F.col("l_partkey") % 100).cast("double") / 100).alias("ratio"))
    found, _ = extraction.figures(_pictures(spark, d, boxes).filter(analysed), _layout_tables(spark, d, boxes).filter(analysed), blocks, blocks.limit(0), _pages(b), ratios)
    lifecycle.discard(boxes)  # the items are read from what figures() has stored
    return found.select(F.col("paper_id").alias("paper"), "kind", "label", F.col("page").cast("int").alias("page"), F.col("render_page").cast("int").alias("render_page"), *[F.col("box")[k].alias(k) for k in ("x0", "y0", "x1", "y1")], "file")


@query("""SELECT doc_id, substr(array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), ' '), 1, 500) AS caption FROM documents""")
def picture_captions(spark, d):
    return load(spark, d, "documents").select("doc_id", layout.joined_caption(F.split("text", "\n")).alias("caption"))


@query("""SELECT conv_id, turn FROM conversations WHERE role = 'assistant' AND text IS NOT NULL""")
def items_done(spark, d):
    items = papers.require(load(spark, d, "conversations"), "conv_id", "turn").withColumn("analysis", F.when(F.col("role") == "assistant", F.col("text")))
    return papers.done_items(items).select("conv_id", "turn")


@query(_SCORED + f""", k AS (SELECT z.item_id, z.pos, z.text, z.role, z.confidence, z.role = 'unknown' AS unknown, round(z.confidence, 3) AS c, list_sort(list_intersect({_TERMS.format("z.text")}, {_TERMS.format("b.text")})) AS ov
  FROM z JOIN benchmark b ON b.item_id = z.item_id - z.item_id % 2 WHERE score >= 2),
l AS (SELECT *, row_number() OVER (PARTITION BY item_id, lower(text) ORDER BY unknown, c DESC, pos) AS n FROM k),
m AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY unknown, c DESC, pos) AS rank FROM l WHERE n = 1)
SELECT item_id, CAST(rank AS INTEGER) AS rank, text, coalesce(nullif(concat_ws('; ', CASE WHEN confidence >= 0.55 THEN 'ocr_confidence_ok' END, CASE WHEN len(ov) > 0 THEN 'context_aligned:' || array_to_string(ov[1:5], ',') END,
  CASE WHEN role IN ({_USEFUL}) THEN 'role=' || role END), ''), 'contextual_candidate') AS reason FROM m WHERE rank <= 18""")
def ocr_reasons(spark, d):
    return ocr.kept(ocr.scored(_fragments(spark, d), _contexts(spark, d))).select("item_id", "rank", "text", "reason")


# The chunks of a paper here are stretches of its words, as it has no paragraphs.
_PAPER_CHUNKS = r""", paper_words AS (SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN w ELSE list_concat(list_concat(list_concat(['Title', 'Abstract'], w[1:n]), list_concat(['Introduction', 'and', 'aims'], w[n + 1:n + 250])),
  list_concat(list_concat(['Methods'], w[n + 251:n + 470]), list_concat(list_concat(['Results'], w[n + 471:n + 770]), list_concat(['Discussion'], w[n + 771:])))) END AS ws FROM doc_words WHERE doc_id IN (SELECT item_id FROM benchmark)),
segments AS (SELECT doc_id, CAST(start AS BIGINT) AS start, CASE WHEN len(ws) * 2 > 750 THEN ws[start + 1:start + 250] ELSE ws END AS seg FROM (SELECT doc_id, ws, unnest(CASE WHEN len(ws) * 2 > 750 THEN range(0, len(ws), 210) ELSE [0] END) AS start FROM paper_words)),
chunks AS (SELECT doc_id AS paper, start // 210 AS chunk_ix, array_to_string(seg, ' ') AS text, len(seg) AS n_words FROM segments WHERE len(seg) >= CASE WHEN start > 0 THEN 20 ELSE 1 END),
tok AS (SELECT paper, chunk_ix, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS t FROM chunks),
idx AS (SELECT paper, chunk_ix, dl, term, count(*) AS tf FROM (SELECT paper, chunk_ix, len(t) AS dl, unnest(t) AS term FROM tok) GROUP BY ALL),
corpus AS (SELECT paper, count(*) AS n, avg(len(t)) AS avgdl FROM tok GROUP BY paper), df AS (SELECT paper, term, count(*) AS df FROM idx GROUP BY ALL),
w0 AS (SELECT paper, term, avgdl, ln((n - df + 0.5) / (df + 0.5)) AS raw FROM df JOIN corpus USING (paper)),
weighed AS (SELECT paper, term, avgdl, CASE WHEN raw < 0 THEN 0.25 * avg(raw) OVER (PARTITION BY paper) ELSE raw END AS okapi FROM w0),
q AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM benchmark) GROUP BY ALL),
hit AS (SELECT item_id, chunk_ix, round(sum(qf * (SCORE)), 10) AS score FROM q JOIN weighed ON weighed.paper = q.item_id AND weighed.term = q.term JOIN idx ON idx.paper = q.item_id AND idx.term = q.term GROUP BY ALL),
ranked AS (SELECT c.paper AS item_id, c.chunk_ix, text, n_words, row_number() OVER (PARTITION BY c.paper ORDER BY coalesce(score, 0.0) DESC, c.chunk_ix) AS rank, count(*) OVER (PARTITION BY c.paper) AS n_chunks FROM chunks c LEFT JOIN hit ON hit.item_id = c.paper AND hit.chunk_ix = c.chunk_ix QUALIFY rank <= 6),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY CASE WHEN n_chunks < 3 THEN rank WHEN rank = 1 THEN 0 WHEN rank = 2 THEN 2 ELSE 1 END, chunk_ix) AS out_pos FROM ranked),
local AS (SELECT item_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY out_pos) AS local, count(*) AS retrieved_chunks, CAST(sum(n_words) AS BIGINT) AS retrieved_words FROM placed GROUP BY item_id)
""".replace("SCORE", _BM25)


@query(_PARTS + _PAPER_CHUNKS + """SELECT item_id, 'bm25' AS mode, md5(local) AS digest, retrieved_chunks, retrieved_words FROM local
UNION ALL SELECT item_id, 'layered', md5('PAPER GLOBAL CONTEXT MAP:' || chr(10) || paper_map || chr(10) || chr(10) || '====' || chr(10) || chr(10) || 'FIGURE/TABLE LOCAL CONTEXT (BM25 top-6 chunks):' || chr(10) || local), retrieved_chunks, retrieved_words
FROM local JOIN maps ON maps.doc_id = local.item_id""")
def retrieved_contexts(spark, d):
    items = load(spark, d, "benchmark").select("item_id", F.col("item_id").cast("string").alias("paper"), F.col("text").alias("caption"))
    docs = load(spark, d, "documents").join(items.select(F.col("item_id").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").cast("string").alias("paper"), F.regexp_replace(_sectioned("doc_id", "text"), "\n{2,}", "\n").alias("text"))
    out = None
    for mode in ("bm25", "layered"):
        rows = pipeline.contexts(items, docs, mode, top_k=6).select("item_id", F.lit(mode).alias("mode"), F.md5(_unmarked(F.col("context")).cast("binary")).alias("digest"), "retrieved_chunks", "retrieved_words")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(r"""WITH occ AS (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS t FROM documents)), idx AS (SELECT doc_id, dl, term, count(*) AS tf FROM occ GROUP BY ALL)
SELECT doc_id // 32 AS range, count(DISTINCT term) AS n_terms, count(*) AS n_postings, CAST(max(tf) AS INTEGER) AS max_tf, round(max(tf / dl), 9) AS max_share FROM idx GROUP BY 1""")
def index_ranges(spark, d):
    _, made = _library(spark, d)
    rows = made.postings.filter("term <> ''").groupBy("range")
    return rows.agg(F.count("term").alias("n_terms"), F.sum("n").alias("n_postings"), F.max("max_tf").alias("max_tf"), F.round(F.max("max_share"), 9).alias("max_share"))


# What the queries' terms may score at most in each range, against the best chunk that the range has.
@query(r"""WITH occ AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM benchmark))
SELECT item_id, CAST(count(DISTINCT doc_id // 32) AS BIGINT) AS ranges, true AS no_more_are_scored FROM q JOIN occ USING (term) GROUP BY item_id""")
def index_skipping(spark, d):
    return index.skipped(*_library(spark, d), 6).select("item_id", "ranges", (F.col("scored") <= F.col("ranges")).alias("no_more_are_scored"))
