"""Hand-made cases for what the driver's tables don't show."""

import pytest
from pyspark.sql import functions as F

from folioflow.functions import retrieval, text
from folioflow.operators import layout, ocr, tables
from folioflow.plans import pipeline, prompts
from folioflow.sources import acquisition, backends, papers
from folioflow.streaming import resume

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


@pytest.fixture(autouse=True, scope="module")
def importable(spark):
    import os

    spark.sparkContext.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("o")).first().o


def test_papers_defaults_and_paging(spark):
    df = spark.createDataFrame([(1, None), (2, " a "), (3, "b"), (4, "c")], "pos long, pmcid string")
    assert [tuple(r) for r in papers.papers(df, limit=3).select("pmcid", "doi", "text_clean").collect()] == [("a", "", ""), ("b", "", "")]
    with pytest.raises(ValueError, match="pmcid"):
        papers.papers(df.drop("pmcid"))
    with pytest.raises(ValueError):
        papers.read_papers(spark)


def test_chunks(spark):
    long = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(f"a b c\n\n{long}\n\nd e f\n\ng h i",)], "t string")
    got = df.select(text.chunks("t", 8, 2).alias("c")).first().c
    assert got[-1] == ["e", "f", "g", "h", "i"] and got[-2] == ["a", "b", "c", "d", "e", "f"]
    got = df.select(text.chunks("t", 26, 2).alias("c")).first().c
    assert [len(c) for c in got] == [26, 9] or got[0][:2] == ["w0", "w1"]
    with pytest.raises(ValueError):
        text.chunks("t", 5, 5)


def test_abstract_and_map(spark):
    paper = "T\nAbstract\nWe did it.\n1. Intro\nbody\nMethods and more\nm1 m2\nReferences\nr"
    assert one(spark, paper, text.abstract) == "We did it."
    assert one(spark, "a  b c", text.abstract) == "a b c"
    got = text.with_context_map(spark.createDataFrame([(paper,), ("",)], "t string"), "t").collect()
    assert got[0].paper_map == "Abstract: We did it.\nMethods / experimental system: m1 m2" and got[1].paper_map == ""


def test_query_without_terms_gets_the_first_chunks(spark):
    chunks = spark.createDataFrame([("p", k, f"word{k} common") for k in range(5)], "paper string, chunk_ix long, text string")
    queries = spark.createDataFrame([(1, "p", "!!"), (2, "p", "word3 word4"), (3, "p", "common")], "item_id long, paper string, query string")
    got = {}
    for r in retrieval.retrieve(queries, chunks, 3, retrieval.tfidf).orderBy("item_id", "out_pos").collect():
        got.setdefault(r.item_id, []).append(r.chunk_ix)
    assert got == {1: [0, 2, 1], 2: [3, 0, 4], 3: [0, 2, 1]}


def test_regions_cascade(spark):
    pages = spark.createDataFrame([("a", 1, 612.0, 792.0), ("a", 2, 612.0, 792.0)], "paper_id string, page int, width double, height double")
    caps = spark.createDataFrame([("a", 1, 0, (50.0, 300.0, 280.0, 320.0), "figure"), ("a", 1, 1, (320.0, 700.0, 560.0, 720.0), "figure"), ("a", 2, 0, (50.0, 500.0, 280.0, 520.0), "table")], f"paper_id string, page int, pos int, box {BOX}, kind string")
    visuals = spark.createDataFrame([("a", 1, (60.0, 100.0, 200.0, 250.0)), ("a", 2, (60.0, 40.0, 280.0, 200.0))], f"paper_id string, page int, box {BOX}")
    texts = spark.createDataFrame([("a", 2, 5, (60.0, 450.0, 250.0, 480.0)), ("a", 2, 6, (60.0, 430.0, 250.0, 445.0)), ("a", 2, 7, (60.0, 300.0, 250.0, 390.0))], f"paper_id string, page int, pos int, box {BOX}")
    got = {(r.page, r.pos): (r.render_page, tuple(r.region)) for r in layout.regions(caps, pages, visuals, texts).collect()}
    assert got[1, 0] == (1, (44.0, 84.0, 216.0, 266.0))
    assert got[2, 0] == (2, (44.0, 414.0, 266.0, 496.0))
    assert got[1, 1] == (1, (44.0, 84.0, 216.0, 266.0))


def test_tables(spark):
    rows = "array<array<string>>"
    assert one(spark, [["a|b", None], ["x\ny", " z "]], tables.markdown, rows) == "| a\\|b |  |\n|---|---|\n| x y | z |"
    assert one(spark, [], tables.markdown, rows) == ""
    assert one(spark, [["Table 1 Continued"]], tables.continues, rows) is True
    t = spark.createDataFrame([("p", 1, 0, [["h", "i"], ["1", "2"]]), ("p", 2, 0, [["(continued)", ""], ["3", "4"]]), ("p", 3, 0, [["n", "m"]])], f"paper_id string, page int, pos int, rows {rows}")
    got = [(r.label, list(r.pages), r.row_count) for r in tables.finished(t).orderBy("label").collect()]
    assert got == [("Table_1", [1, 2], 3), ("Table_2", [3], 1)]


@pytest.mark.parametrize(("fragment", "role"), [("A", "panel_label"), ("p<0.05", "statistical_marker"), ("**", "statistical_marker"), ("n = 3", "sample_size"), ("r²", "statistical_marker"), ("5 µM", "measurement_or_unit"), ("5 mg", "measurement_or_unit"), ("50%", "unknown"), ("wild-type", "condition_or_group"), ("IL6", "biological_entity_or_label"), ("fold change", "axis_or_dimension"), ("-1.5", "numeric_value"), ("word", "unknown")])
def test_roles(spark, fragment, role):
    assert one(spark, fragment, ocr.role) == role


def test_ocr_summary_without_fragments(spark):
    items = spark.createDataFrame([(1,)], "item_id long")
    none = spark.createDataFrame([], "item_id long, pos int, text string, confidence double")
    got = ocr.summaries(items, none, spark.createDataFrame([(1, "x")], "item_id long, alignment string")).first()
    assert (got.quality, got.use_policy, got.kept_fragments) == ("unavailable", "ignore", [])
    assert got.discarded_summary == "OCR unavailable or returned no usable text."


@pytest.mark.parametrize(("answer", "found"), [('{"confidence": "high"}', "high"), ('```json\n{"confidence": "low"}\n```', "low"), ('So: {"confidence": "mid"} yes', "mid"), ("[1]", "unknown"), ("no", "unknown"), ("{}", "unknown"), ("", "unknown")])
def test_answers(spark, answer, found):
    assert one(spark, answer, lambda c: prompts.confidence(prompts.parsed(c))) == found


def test_urls(spark):
    assert one(spark, "https://x.org/a/b-12-034.pdf/", acquisition.cdn_url) == "https://res.mdpi.com/b/b-12-034/article_deploy/b-12-034.pdf"
    assert one(spark, "https://x.org/b-12.pdf", acquisition.cdn_url) is None
    assert one(spark, '{"oa_locations": [{"url_for_pdf": "", "url": "u"}, {"url_for_pdf": "p"}, {}]}', acquisition.open_access_urls) == ["u", "p"]
    assert one(spark, '{"message": {"link": [{"content-type": "application/PDF", "URL": "a"}, {"URL": "b.pdf"}, {"URL": "c"}]}}', acquisition.crossref_urls) == ["a", "b.pdf"]
    assert one(spark, "broken", acquisition.crossref_urls) == []


class Fetch:
    def get(self, url):
        if "pmc" in url and "europe" not in url:
            raise OSError("gone")
        return b"%PDF" if "europe" in url else b"html"


def packed(name):
    import io
    import tarfile

    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        for file, data in (("a/readme.txt", b"x"), (name, b"%PDF packed")):
            info = tarfile.TarInfo(file)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


class Services:
    """Each paper's PDF is at one address only, most of them known to a service alone; others answer with pages."""

    ANSWERS = {
        "unpaywall.org/v2/10.1/oa?email=me@x.org": b'{"oa_locations": [{"url_for_pdf": "http://oa.org/1.pdf"}]}',
        "unpaywall.org/v2/10.1/cdn?email=me@x.org": b'{"oa_locations": [{"url": "http://pmc.ncbi.nlm.nih.gov/p/jour-9-77.pdf"}]}',
        "crossref.org/works/10.1/cross": b'{"message": {"link": [{"content-type": "application/pdf", "URL": "http://cross.org/file"}]}}',
        "oa.fcgi?id=PMC5": b"""<OA><records><record><link href='ftp://f/PMC5.tar.gz' format='tgz'/></record></records></OA>""",
        "http://oa.org/1.pdf": b"%PDF oa", "http://cross.org/file": b"%PDF cross", "doi.org/10.1/res": b"%PDF res", "accid=PMC6&": b"%PDF mirror", "ftp://f/PMC5.tar.gz": packed("a/b.pdf"),
        "res.mdpi.com/jour/jour-9-77/": b"%PDF cdn", "res.mdpi.com/red/red-1-2/": b"%PDF redirect",
    }

    def get(self, url):
        if "/articles/PMC7/" in url:
            return b"<html>", "https://pmc.ncbi.nlm.nih.gov/articles/red-1-2.pdf"
        for part, answer in self.ANSWERS.items():
            if part in url:
                return answer, url
        if "unpaywall" in url:
            raise OSError("403")
        return b"<html>", url


class Model:
    def ask(self, prompt, image):
        if image == b"bad":
            raise ValueError("no")
        return '{"confidence": "high", "data_and_patterns": "found"}'


class Engine:
    def read(self, image):
        return [("A", 0.9), ("12", 0.2)]


def test_download_chain(spark):
    """Lookups, CDN variants, redirects, mirror, resolver and packed articles, in this order; the rest has an error."""
    p = [("PMC1", "10.1/oa"), ("PMC2", "10.1/cdn"), ("PMC3", "10.1/cross"), ("PMC4", "https://doi.org/10.1/res"), ("PMC5", ""), ("PMC6", "10.1/none"), ("PMC7", None), ("PMC8", "10.1/none"), ("PMC9", "10.1/oa")]
    have = spark.createDataFrame([("PMC9",)], "pmcid string")
    rows = backends.downloaded(spark.createDataFrame(p, "pmcid string, doi string"), have, "me@x.org", Services).collect()
    assert {r.pmcid: (r.kind, bytes(r.content or b"").decode(), r.error) for r in rows} == {
        "PMC1": ("open_access", "%PDF oa", None), "PMC2": ("cdn", "%PDF cdn", None), "PMC3": ("crossref", "%PDF cross", None), "PMC4": ("resolver", "%PDF res", None),
        "PMC5": ("archive", "%PDF packed", None), "PMC6": ("europe_pmc", "%PDF mirror", None), "PMC7": ("cdn", "%PDF redirect", None), "PMC8": (None, "", "pdf_download_failed:PMC8"),
    }


def test_ocr_answers_of_any_shape():
    class Found:
        txts, scores = ["a  b", " ", "c"], [0.5, 0.1]

    assert backends.fragments(Found()) == [("a b", 0.5), ("c", 0.0)]
    assert backends.fragments(([["box", "t\n", "0.25"], ["u", 1], {"rec_text": "v", "score": 0.5}, {"text": ""}, 7], "time")) == [("t", 0.25), ("u", 1.0), ("v", 0.5)]
    assert backends.fragments(None) == [] and backends.fragments([["x", "y", "no"]]) == [("y", 0.0)]


def test_model_server(monkeypatch):
    import sys
    import types

    asked = []

    class Answer:
        status_code = 200

        def raise_for_status(self):
            pass

        def json(self):
            return {"choices": [{"message": {"content": " \n"}}]}

    class Session:
        def get(self, url, timeout):
            asked.append(url)
            return Answer()

        def post(self, url, json, timeout):
            asked.append(json)
            return Answer()

    monkeypatch.setitem(sys.modules, "requests", types.SimpleNamespace(Session=Session))
    model = backends.HttpVisionModel("http://h/v1/x/v1/chat/completions")
    assert model.healthy() and asked == ["http://h/v1/x/health"]
    with pytest.raises(RuntimeError, match="empty"):
        backends.patient(lambda: model.ask("p", b"i"), sleep=lambda s: None)
    body = asked[-1]
    assert body["stream"] is False and [c["type"] for c in body["messages"][0]["content"]] == ["image_url", "text"]
    model.ask("p", None)
    assert [c["type"] for c in asked[-1]["messages"][0]["content"]] == ["text"]


class Painter:
    def render(self, content, page, box, dpi, rotated):
        if page == 9:
            raise ValueError("no page")
        return content + b"%d" % page, 300, 200


def test_render(spark):
    box = (10.0, 10.0, 110.4, 60.6)
    regions = spark.createDataFrame([("p", "Figure 1", "figure", 1, box, False), ("p", "Table_1", "table", 2, box, True), ("p", "Figure 2", "figure", 9, box, False)], f"paper_id string, label string, kind string, page int, box {BOX}, rotated boolean")
    pdfs = spark.createDataFrame([("p", b"x")], "paper_id string, content binary")
    got = {r.label: (bytes(r.image or b""), r.image_size, r.error is None) for r in backends.render(regions, pdfs, Painter).collect()}
    assert got == {"Figure 1": (b"x1", [100, 51], True), "Table_1": (b"x2", [300, 200], True), "Figure 2": (b"", None, False)}


def test_tables_of_papers(spark):
    """Strict before default by page, continued ones joined, the second detector for papers without any, captions."""
    rows = lambda *names: [["h", *names], ["1", "2", "3"], ["4", "5", "6"]]
    kind = f"paper_id string, page int, pos int, box {BOX}, rows array<array<string>>"
    big, tall = (50.0, 100.04, 250.0, 200.0), (50.0, 100.0, 90.0, 300.0)
    strict = spark.createDataFrame([("a", 1, 0, big, rows("x", "y")), ("a", 1, 1, (50.0, 100.0, 250.01, 200.0), rows("again", "z")), ("a", 2, 0, big, [["Table 1 (Continued)", "", ""], ["7", "8", "9"], ["7", "8", "9"]])], kind)
    default = spark.createDataFrame([("a", 1, 0, big, rows("default", "d")), ("a", 3, 0, tall, rows("late", "d")), ("b", 1, 0, (0.0, 0.0, 10.0, 10.0), rows("tiny", "d"))], kind)
    lattice = spark.createDataFrame([("b", 1, 0, (0.0, 92.0, 400.0, 192.0), rows("lat", " t "), 80.0), ("b", 1, 1, big, rows("bad", "t"), 49.9), ("a", 1, 0, big, rows("unused", "t"), 99.0)], kind + ", accuracy double")
    pages = spark.createDataFrame([(p, n, 612.0, 792.0) for p in "ab" for n in (1, 2, 3)], "paper_id string, page int, width double, height double")
    lines = spark.createDataFrame([("a", 1, 0, (50.0, 60.0, 200.0, 70.0), " Table 1: first "), ("a", 1, 1, (50.0, 72.0, 200.0, 80.0), "second line"), ("b", 1, 0, (0.0, 710.0, 200.0, 720.0), "Tabla S1. below"), ("b", 1, 1, (0.0, 590.0, 200.0, 595.0), "just text")], f"paper_id string, page int, pos int, box {BOX}, text string")
    got = {(r.paper_id, r.label): r for r in tables.extracted(strict, default, lattice, pages, lines).collect()}
    assert set(got) == {("a", "Table_1"), ("a", "Table_2"), ("b", "Table_1")}
    one, two, other = got["a", "Table_1"], got["a", "Table_2"], got["b", "Table_1"]
    assert (one.pages, one.row_count, one.caption, one.rotated, tuple(one.box)) == ([1, 2], 5, "Table 1: first second line", False, (50.0, 100.0, 250.0, 200.0))
    assert (two.page, two.rotated, two.caption) == (3, True, "") and one.file == "p001_Table_1.png"
    assert (tuple(other.box), other.rows[0], other.caption, other.accuracy) == ((0.0, 600.0, 400.0, 700.0), ["h", "lat", "t"], "Tabla S1. below", 80.0)


def test_figures_of_papers(spark):
    """Layout analysis first; a paper without its results gets those of its captions, the strip above them at last."""
    from folioflow.plans import extraction

    box = lambda *b: tuple(float(x) for x in b)
    schema = f"paper_id string, pos int, page int, box {BOX}, caption string"
    pictures = spark.createDataFrame([("a", 0, 1, box(0, 0, 50, 50), None), ("a", 1, None, box(0, 0, 500, 500), None), ("a", 2, 1, box(0, 0, 50, 50), "Logo of X"), ("a", 3, 2, box(0, 0, 500, 500), "\t"), ("a", 4, 2, box(0, 0, 50, 50), "fig.  7b")], schema)
    found = spark.createDataFrame([("a", 0, 3, box(0, 0, 9, 9), "Table IV here"), ("a", 1, 3, box(0, 0, 9, 9), None)], schema)
    text = lambda *parts: [[p] for p in parts]
    blocks = spark.createDataFrame([("b", 1, 0, 0, box(50, 300, 280, 320), text("Figure 1. x")), ("b", 1, 1, 1, box(60, 100, 200, 250), None), ("b", 2, 0, 0, box(50, 400, 280, 420), text("Fig. 2 y")), ("b", 2, 1, 0, box(320, 5, 560, 9), text("Figure 3"))], f"paper_id string, page int, pos int, type int, box {BOX}, lines array<array<string>>")
    drawings = spark.createDataFrame([("b", 2, 0, box(0, 0, 2, 700))], f"paper_id string, page int, pos int, box {BOX}")
    pages = spark.createDataFrame([("b", 1, 612.0, 792.0), ("b", 2, 612.0, 792.0)], "paper_id string, page int, width double, height double")
    ratios = spark.createDataFrame([("b", 2, 0, 0.9), ("b", 2, 1, 0.5)], "paper_id string, page int, pos int, ratio double")
    items, skipped = extraction.figures(pictures, found, blocks, drawings, pages, ratios)
    got = {(r.paper_id, r.label): (r.kind, r.page, tuple(r.box)) for r in items.collect()}
    assert got == {
        ("a", "Figure_uncaptioned_1"): ("figure", 1, box(0, 0, 50, 50)), ("a", "Figure_uncaptioned_2"): ("figure", 2, box(0, 0, 500, 500)), ("a", "Figure 7"): ("figure", 2, box(0, 0, 50, 50)),
        ("a", "Table IV"): ("table", 3, box(0, 0, 9, 9)), ("a", "Table_2"): ("table", 3, box(0, 0, 9, 9)),
        ("b", "Figure 1"): ("figure", 1, box(44, 84, 216, 266)), ("b", "Figure 2"): ("figure", 2, box(0, 0, 322, 416)),
    }
    assert [(r.label, r.reason, list(r.bbox_size)) for r in skipped.collect()] == [("Picture_1", "small_uncaptioned", [50, 50])]


def test_white_space_is_more_than_spaces(spark):
    df = spark.createDataFrame([(1, "\t"), (2, "\u3000a\n")], "pos long, pmcid string")
    assert [r.pmcid for r in papers.papers(df).collect()] == ["a"]
    assert one(spark, [["\n", "\t"], ["x", "y"]], tables.filled_cells, "array<array<string>>") == 2
    assert one(spark, "\nhttps://doi.org/10.1/x\t", acquisition.clean_doi) == "10.1/x"


def test_files_of_a_run(spark, tmp_path):
    """Items of figures and, if they are there, tables; the summary is one file; folders are emptied; PDFs go."""
    import json
    import os

    from folioflow.sources import lifecycle

    out = lifecycle.prepared_folder(spark, str(tmp_path / "out"))
    (tmp_path / "out" / "figures.json").write_text(json.dumps({"items": [{"label": "f1"}, {"label": "f2"}]}))
    assert [r.label for r in papers.read_items(spark, f"{out}/figures.json", f"{out}/tables.json").orderBy("pos").collect()] == ["f1", "f2"]
    (tmp_path / "out" / "tables.json").write_text(json.dumps({"items": [{"label": "t1", "rows": 3}]}))
    assert [(r.label, r.rows) for r in papers.read_items(spark, f"{out}/figures.json", f"{out}/tables.json").orderBy("part", "pos").collect()] == [("f1", None), ("f2", None), ("t1", 3)]
    for n in (2, 1):
        lifecycle.write_summary(spark.range(n).withColumn("status", F.lit("ok")).repartition(3), f"{out}/summary")
    files = [f for f in os.listdir(f"{out}/summary") if f.startswith("part-")]
    assert len(files) == 1 and json.loads((tmp_path / "out" / "summary" / files[0]).read_text()) == {"id": 0, "status": "ok"}
    (tmp_path / "out" / "paper.pdf").write_bytes(b"%PDF")
    assert lifecycle.without_pdfs(spark, [f"{out}/paper.pdf"], keep=True) == 0 and lifecycle.without_pdfs(spark, [f"{out}/paper.pdf", f"{out}/none.pdf"]) == 1
    for k in range(5):
        (tmp_path / "out" / f"{k}.pdf").write_bytes(b"%PDF")
    gone = lifecycle.without_files(spark.createDataFrame([(f"file://{out}/{k}.pdf",) for k in range(7)], "path string").repartition(3))
    assert sorted((r.path[-5], r.gone) for r in gone.collect()) == [(str(k), k < 5) for k in range(7)] and not list((tmp_path / "out").glob("*.pdf"))
    lifecycle.prepared_folder(spark, out, clean=True)
    assert os.listdir(out) == []


class Teller:
    def ask(self, prompt, image):
        if "[bad]" in prompt:
            raise ValueError("no")
        return '{"main_contribution": "m"}' if "[t1]" in prompt else "prose"


def test_synthesis(spark, monkeypatch):
    monkeypatch.setattr(backends, "FIRST_WAIT", 0.0)
    rows = spark.createDataFrame([(1, "p", "t1"), (2, "q", "t2"), (3, "r", "bad")], "item_id long, paper string, label string")
    results = rows.withColumns({"kind": F.lit("table"), "caption": F.lit("c"), "analysis_parsed": F.parse_json(F.lit("{}"))})
    docs = spark.createDataFrame([("p", "Title\nAbstract\nWhat it is.\nResults\n")], "paper string, text string")
    assert "Abstract: What it is." in pipeline.synthesis_prompts(results, docs).filter("paper = 'p'").first().prompt
    out = pipeline.synthesise(results, docs, Teller)
    got = {r.paper: (r.s, r.error) for r in out.select("paper", F.to_json("paper_summary").alias("s"), "error").collect()}
    assert got == {"p": ('{"main_contribution":"m"}', None), "q": ('{"raw":"prose"}', None), "r": (None, "ValueError('no')")}


def test_backends(spark):
    p = spark.createDataFrame([("PMC1", "10.1/x"), ("", "10.1/y")], "pmcid string, doi string")
    got = {r.pmcid: (r.kind, bytes(r.content or b""), r.error is None) for r in backends.fetch_first(acquisition.direct_candidates(p), Fetch).collect()}
    assert got == {"PMC1": ("europe_pmc", b"%PDF", True), "": (None, b"", False)}
    images = spark.createDataFrame([(1, b"x")], "item_id long, image binary")
    assert [(r.text, r.pos) for r in backends.read_ocr(images, Engine).collect()] == [("A", 0), ("12", 1)]


@pytest.mark.parametrize("mode", pipeline.MODES)
def test_analysis(spark, mode, monkeypatch):
    monkeypatch.setattr(backends, "FIRST_WAIT", 0.0)
    items = spark.createDataFrame([(1, "p", "Figure 1", "figure", "alpha"), (2, "p", "Table 1", "table", None), (3, "p", "Figure 2", "figure", "x"), (4, "p", "Figure 3", "figure", "y")], "item_id long, paper string, label string, kind string, caption string")
    docs = spark.createDataFrame([("p", "alpha beta\n\ngamma")], "paper string, text string")
    images = spark.createDataFrame([(1, b"ok"), (2, b"ok"), (4, b"ok")], "item_id long, image binary")
    done = spark.createDataFrame([("p", "Figure 3")], "paper string, label string")
    out = pipeline.analyse(items, docs, images, Model, done=done, mode=mode)
    got = {r.item_id: (r.confidence, r.analysis_error) for r in out.collect()}
    assert got == {1: ("high", None), 2: ("high", None), 3: ("unknown", "image missing")}
    assert "finding: found" in pipeline.synthesis_prompts(out).first().block


def test_patience():
    calls = []

    def fail():
        calls.append(1)
        raise OSError("x")

    with pytest.raises(OSError):
        backends.patient(fail, sleep=lambda s: calls.append(s))
    assert calls == [1, 3.0, 1, 6.0, 1, 12.0, 1, 24.0, 1]


def test_stream_is_the_batch(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id long, text string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(source)
    for _ in range(2):  # nothing new the second time
        q = resume.analyse_stream(spark, source, schema, lambda b: b.withColumn("n", F.length("text")), str(tmp_path / "out"), str(tmp_path / "check"))
        q.awaitTermination(60)
    assert sorted((r.id, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, 1), (2, 1)]


def test_sections_hold_the_whole_text(spark):
    """No word of a long document is left out of the paper that is made of it."""
    from folioflow.plans import queries

    words = [f"w{k}" for k in range(1_500)]
    paper = spark.createDataFrame([(" ".join(words),)], "text string").select(F.lit(3).alias("doc_id"), "text").select(queries._sectioned("doc_id", "text").alias("p")).first().p
    assert [w for w in paper.split() if w[0] == "w" and w[1:].isdigit()] == words


def test_a_page_of_many_captions(spark):
    """The boundary above each of 50,000 captions of one page, in one pass over their edges."""
    import numpy as np

    rng = np.random.default_rng(4)
    x, y, h = rng.integers(0, 500, 50_000), rng.integers(0, 90_000, 50_000) / 4, rng.integers(1, 40, 50_000)
    rows = [("a", 1, k, (float(x[k]), float(y[k]), float(x[k]) + 60, float(y[k]) + float(h[k]))) for k in range(50_000)]
    caps = spark.createDataFrame(rows, f"paper_id string, page int, pos int, box {BOX}")
    pages = spark.createDataFrame([("a", 1, 612.0, 22_600.0)], "paper_id string, page int, width double, height double")
    got = {r.pos: (r.column, r.prev) for r in layout.with_boundary(caps, pages).select("pos", "column", "prev").collect()}
    assert len(got) == 50_000
    edges = {}
    for k, (column, _) in got.items():
        edges.setdefault(column, []).append(y[k] + h[k])
    edges = {c: np.sort(e) for c, e in edges.items()}
    for k in range(0, 50_000, 97):
        column, prev = got[k]
        at = np.searchsorted(edges[column], y[k])
        assert prev == (edges[column][at - 1] if at else 0)


def test_trimming_is_linear(spark):
    """A megabyte of blanks between two letters; with a pattern the cost grew with its square."""
    import time

    df = spark.createDataFrame([(" a" + " \t\n" * 350_000 + "b　\x1c",)], "t string")
    began = time.monotonic()
    got = df.select(F.length(text.stripped("t")).alias("n"), text.stripped("t").startswith("a ").alias("a"), text.first_words("t", 3).alias("w")).first()
    assert (got.n, got.a, got.w) == (1_050_002, True, "a b") and time.monotonic() - began < 10
    every = "".join(map(chr, range(0x3100)))
    kept = [c for c in every if spark_space(c)]
    assert text.SPACES == "".join(kept)


def spark_space(c):
    """The characters of SPACE: ASCII white space, separators and the four information separators, and next line."""
    import unicodedata

    return c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85" or unicodedata.category(c).startswith("Z")
