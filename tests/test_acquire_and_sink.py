"""Waves of downloads, files of papers, fallback on demand, and analyses that are asked once."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from folioflow.sources import backends, paper_files, papers
from folioflow.streaming import once


class Server:
    """Notes every request as a file: host, address, time. Addresses with ok in them give a PDF."""

    def __init__(self, folder, size=0):
        self.folder, self.size = folder, size

    def get(self, url):
        with open(f"{self.folder}/requests-{os.getpid()}", "a") as f:
            f.write(json.dumps([url, time.monotonic()]) + "\n")
        if "broken" in url:
            raise OSError("no")
        return b"%PDF" + url.encode() + b"x" * self.size if "ok" in url else b"<html>"


def requests(folder):
    return [json.loads(line) for name in os.listdir(folder) if name.startswith("requests") for line in open(f"{folder}/{name}")]


def addresses(spark, rows):
    return spark.createDataFrame(rows, "pmcid string, rank int, pos int, kind string, url string").repartition(4)


def test_waves_ask_no_later_rank(spark, tmp_path):
    rows = [("A", 1, 0, "x", "http://one/ok/A"), ("A", 2, 0, "y", "http://two/ok/A2"), ("B", 1, 0, "x", "http://one/no"), ("B", 1, 1, "x", "http://one/ok/B"), ("B", 1, 2, "x", "http://one/never"), ("B", 3, 0, "z", "http://three/never"), ("C", 1, 0, "x", "http://one/broken"), ("C", 3, 0, "z", "http://three/ok/C"), ("D", 1, 0, "x", "http://one/no"), ("D", 3, 0, "z", "http://three/broken"), ("E", 2, 0, "y", "http://two/no")]
    got = {r.pmcid: (r.kind, r.content and bytes(r.content), r.error) for r in backends.fetch_first(addresses(spark, rows), lambda f=str(tmp_path): Server(f)).collect()}
    assert {k: v[0] for k, v in got.items()} == {"A": "x", "B": "x", "C": "z", "D": None, "E": None}
    assert got["B"][1] == b"%PDFhttp://one/ok/B" and "OSError" in got["D"][2] and "not accepted" in got["E"][2]
    seen = [u for u, _ in requests(tmp_path)]
    assert len(seen) == len(set(seen)) + 1 and not [u for u in seen if "never" in u or "A2" in u]  # http://one/no for two papers
    assert backends.fetch_first(addresses(spark, []), lambda: Server("")).collect() == []


def test_a_host_sees_its_rate(spark, tmp_path):
    rows = [(f"P{k}", 1, 0, "x", f"http://{'slow' if k % 2 else 'quick'}/ok/{k}") for k in range(24)]
    got = backends.fetch_first(addresses(spark, rows), lambda f=str(tmp_path): Server(f), pauses={"slow": 0.15}, lanes=2)
    assert got.filter("content is not null").count() == 24
    times = {h: sorted(t for u, t in requests(tmp_path) if h in u) for h in ("slow", "quick")}
    assert times["slow"][-1] - times["slow"][0] >= 0.15 * 9 and times["quick"][-1] - times["quick"][0] < 1.5
    assert all(b - a >= 0.28 for a, b in zip(times["slow"], times["slow"][2:], strict=False) if b)  # two lanes, each at half the rate


def test_every_pdf_leaves_the_worker(spark, tmp_path):
    """What a worker holds doesn't grow with the number of PDFs."""
    rows = [(f"P{k}", 1, 0, "x", f"http://one/ok/{k}") for k in range(60)]
    wave = backends.fetch_wave(addresses(spark, rows), lambda f=str(tmp_path): Server(f, 5 << 20))

    def peak(frames):
        import resource

        import pandas as pd

        n = sum(int(f["n"].sum()) for f in frames)
        yield pd.DataFrame({"n": [n], "kb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss]})

    sizes = wave.select(F.length("content").cast("long").alias("n")).coalesce(1).mapInPandas(peak, "n long, kb long").collect()
    assert sum(r.n for r in sizes) > 60 * (5 << 20) and max(r.kb for r in sizes) < 500 << 10


def files_below(folder):
    return sorted(os.path.relpath(os.path.join(d, n), folder) for d, _, names in os.walk(folder) for n in names if not n.startswith(".") or "_staging" in d)


def test_files_of_papers(spark, tmp_path):
    uri = f"file://{tmp_path}/run"
    items = spark.createDataFrame([("A", 1, "f1"), ("A", 0, "f0"), ("B", 0, "g")], "paper string, pos int, label string")
    made = papers.enveloped(items, "paper", "pos", ["label"])
    paper_files.write_files(paper_files.envelope_files(made, "paper", "figures.json"), uri)
    paper_files.write_files(spark.createDataFrame([("A", "fig.png", b"\x89PNG"), ("A", "empty.txt", None)], paper_files.ROW), uri)
    assert files_below(f"{tmp_path}/run") == ["A/empty.txt", "A/fig.png", "A/figures.json", "B/figures.json"]
    back = {r.paper: bytes(r.content).decode() for r in paper_files.read_files(spark, uri, "figures.json").collect()}
    assert back == {r.paper: r.document for r in made.collect()}
    rows = spark.createDataFrame([("A", "10.1/x", "T", "whole text"), ("C", "", "", "")], "pmcid string, doi string, title string, text_clean string")
    paper_files.write_files(paper_files.context_files(rows), uri)
    assert (tmp_path / "run/A/paper.txt").read_text() == "whole text" and json.loads((tmp_path / "run/C/context.json").read_text())["pmcid"] == "C" and not (tmp_path / "run/C/paper.txt").exists()
    pictures = spark.createDataFrame([("A", "Figure 1", b"new"), ("B", "Figure 1", None)], "paper_id string, label string, image binary")
    names = spark.createDataFrame([("A", "Figure 1", "fig.png"), ("B", "Figure 1", "fig.png")], "paper_id string, label string, name string")
    paper_files.write_files(paper_files.image_files(pictures, names), uri)
    assert (tmp_path / "run/A/fig.png").read_bytes() == b"new" and not (tmp_path / "run/B/fig.png").exists()


@pytest.mark.parametrize("bad", ["a/b", "..", None])
def test_a_failed_write_leaves_nothing(spark, tmp_path, bad):
    uri = f"file://{tmp_path}/run"
    paper_files.write_files(spark.createDataFrame([("A", "kept.txt", b"old")], paper_files.ROW), uri)
    rows = spark.createDataFrame([(f"P{k}", "x.txt", b"y") for k in range(50)] + [("A", "kept.txt", b"new"), ("Z", bad, b"y")], paper_files.ROW).repartition(4)
    with pytest.raises(Exception, match="no name of a folder"):
        paper_files.write_files(rows, uri)
    assert files_below(f"{tmp_path}/run") == ["A/kept.txt"] and (tmp_path / "run/A/kept.txt").read_bytes() == b"old"


def test_fallback_sees_only_what_is_lacking(spark, tmp_path):
    wanted = spark.createDataFrame([(f"P{k}", k) for k in range(20)], "paper_id string, n long")
    first = wanted.filter("n < 15").select("paper_id", F.lit("first").alias("by"))

    def detector(lacking):
        def run(frames):
            for f in frames:
                with open(f"{tmp_path}/seen", "a") as file:
                    file.write("".join(f"{p}\n" for p in f["paper_id"]))
                yield f[["paper_id"]].assign(by="second")

        return lacking.mapInPandas(run, "paper_id string, by string")

    got = papers.or_else_on_demand(wanted, first, detector, "paper_id")
    assert sorted(map(tuple, got.collect())) == sorted((f"P{k}", "first" if k < 15 else "second") for k in range(20))
    assert sorted((tmp_path / "seen").read_text().split()) == sorted(f"P{k}" for k in range(15, 20))
    assert papers.or_else_on_demand(wanted, wanted.select("paper_id", F.lit("first").alias("by")), detector, "paper_id").count() == 20


class Model:
    """Counts questions; while a file ``stop`` is there, it kills the task at the fourth question."""

    def __init__(self, folder):
        self.folder = folder

    def ask(self, prompt, image):
        with open(f"{self.folder}/asked", "a") as f:
            f.write(prompt + "\n")
        if os.path.exists(f"{self.folder}/stop") and sum(1 for _ in open(f"{self.folder}/asked")) >= 4:
            os._exit(1)
        if prompt == "bad" and not os.path.exists(f"{self.folder}/mended"):
            raise ValueError("no")
        return f"about {prompt}"


def test_items_are_asked_once(spark, tmp_path, monkeypatch):
    """A stream that is killed in the middle of a batch and restarted asks nothing twice and gives every answer once."""
    monkeypatch.setattr(backends, "ATTEMPTS", 1)
    kind = "paper string, label string, prompt string, image binary"
    source, out, check, journal = (f"{tmp_path}/{n}" for n in ("in", "out", "check", "journal"))
    items = [(f"P{k % 3}", f"Figure {k}", f"q{k}", b"i") for k in range(8)]
    spark.createDataFrame([*items, items[0]], kind).coalesce(1).write.parquet(f"{source}/1")
    schema = spark.createDataFrame([], kind).schema

    def run():
        rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
        found = once.analyse_once(rows, lambda f=str(tmp_path): Model(f), f"file://{journal}")
        query = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
        query.awaitTermination()

    (tmp_path / "stop").write_text("")
    with pytest.raises(Exception):  # noqa: B017, PT011
        run()
    (tmp_path / "stop").unlink()
    before = (tmp_path / "asked").read_text().split()
    assert 4 <= len(before) <= 8
    run()
    answers = sorted((r.label, r.answer) for r in spark.read.parquet(out).collect())
    assert answers == sorted((label, f"about {q}") for _, label, q, _ in items)
    seen = (tmp_path / "asked").read_text().split()
    lost = [q for q in set(seen) if seen.count(q) > 1]
    assert len(lost) <= 4  # only a question that was open when a task died is put again
    again = [("P0", "Figure 0", "q0 again", b"i"), ("P9", "Figure 9", "bad", b"i")]
    spark.createDataFrame(again, kind).coalesce(1).write.parquet(f"{source}/2")
    run()
    rows = {(r.label, r.answer): r.analysis_error for r in spark.read.parquet(out).collect()}
    assert len(rows) == 9 and "ValueError" in rows["Figure 9", None] and "q0 again" not in (tmp_path / "asked").read_text()
    (tmp_path / "mended").write_text("")
    spark.createDataFrame(again[1:], kind).coalesce(1).write.parquet(f"{source}/3")
    run()
    assert ("Figure 9", "about bad") in {(r.label, r.answer) for r in spark.read.parquet(out).collect()}
