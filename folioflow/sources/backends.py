"""What Spark can't do itself, behind small replaceable classes: PDF reading, OCR, HTTP and the vision-language model.

Each operator runs a backend in ``mapInPandas``. The backend is made once per partition by a factory, errors become
values, and tests use fakes.
"""

from __future__ import annotations

import base64
import io
import tarfile
import time
from collections.abc import Callable, Iterator
from typing import Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .acquisition import PAUSE, PAUSES
from .lifecycle import importable, scratch

ATTEMPTS, FIRST_WAIT = 5, 3.0


class Fetcher(Protocol):
    """``get`` gives the content, or the content and the address that it came from in the end."""

    def get(self, url: str) -> bytes | tuple[bytes, str]: ...


class Renderer(Protocol):
    """``render`` gives a PNG of a box of a page (from 1) and its width and height in pixels."""

    def render(self, content: bytes, page: int, box: tuple[float, float, float, float], dpi: int, rotated: bool) -> tuple[bytes, int, int]: ...


class VisionModel(Protocol):
    def ask(self, prompt: str, image: bytes) -> str: ...


class Ocr(Protocol):
    def read(self, image: bytes) -> list[tuple[str, float]]: ...


class PdfReader(Protocol):
    def pages(self, content: bytes) -> list[str]: ...


class HttpFetcher:
    """GET by the requests library (FTP by the standard one), with a pause before each call and an honest user agent.

    ``pauses`` and ``referers`` say what holds for a host; ``pause`` and ``referer`` hold for all others. Where
    ``fetch_wave`` keeps the rate of a host, give a pause of 0 here.
    """

    def __init__(self, pause: float = PAUSE, timeout: float = 60, agent: str = "folioflow/1.0", referer: str = "", jitter: float = 0.8, pauses: dict[str, float] = PAUSES, referers: dict[str, str] | None = None):
        import requests

        self.session, self.pause, self.timeout, self.jitter = requests.Session(), pause, timeout, jitter
        self.referer, self.pauses, self.referers = referer, pauses if pause else {}, referers or {}
        self.session.headers.update({"User-Agent": agent, "Accept": "application/pdf,*/*"})

    def get(self, url: str) -> tuple[bytes, str]:
        import random

        host = urlsplit(url).hostname or ""
        time.sleep(self.pauses.get(host, self.pause) + random.uniform(0, self.jitter))
        referer = self.referers.get(host, self.referer)
        if url.startswith("ftp://"):
            from urllib.request import urlopen

            with urlopen(url, timeout=self.timeout) as answer:
                return answer.read(), url
        answer = self.session.get(url, timeout=self.timeout, headers={"Referer": referer} if referer else None)
        answer.raise_for_status()
        return answer.content, answer.url


class HttpVisionModel:
    """A chat-completions server: the image first, then the prompt."""

    def __init__(self, server: str, max_tokens: int = 1500, temperature: float = 0.0, timeout: float = 300):
        import requests

        self.session, self.server = requests.Session(), server
        self.max_tokens, self.temperature, self.timeout = max_tokens, temperature, timeout

    def healthy(self) -> bool:
        try:
            return self.session.get(self.server.rsplit("/v1/", 1)[0] + "/health", timeout=5).status_code == 200
        except OSError:
            return False

    def ask(self, prompt: str, image: bytes | None) -> str:
        seen = [] if image is None else [{"type": "image_url", "image_url": {"url": data_url(image)}}]
        content = [*seen, {"type": "text", "text": prompt}]
        body = {"messages": [{"role": "user", "content": content}], "max_tokens": self.max_tokens, "temperature": self.temperature, "repeat_penalty": 1.15, "stream": False}
        answer = self.session.post(self.server, json=body, timeout=self.timeout)
        answer.raise_for_status()
        return answer.json()["choices"][0]["message"]["content"]


def data_url(image: bytes) -> str:
    return "data:image/png;base64," + base64.b64encode(image).decode()


def patient(call: Callable[[], str], attempts: int = ATTEMPTS, wait: float = FIRST_WAIT, sleep=time.sleep) -> str:
    """The first answer that isn't blank, without white space around it; waits double between attempts, and the last error is raised."""
    error: Exception = RuntimeError("empty answer")
    for n in range(attempts):
        try:
            if answer := (call() or "").strip():
                return answer
        except Exception as e:
            error = e
        if n + 1 < attempts:
            sleep(wait * 2**n)
    raise error


def cdn_address(url: str) -> str | None:
    """The publisher's CDN address of a file a-b-c.pdf, as ``acquisition.cdn_url`` has it; None for other names."""
    name = url.rstrip("/").rpartition("/")[2]
    parts = name.removesuffix(".pdf").rsplit("-", 2)
    return f"https://res.mdpi.com/{parts[0]}/{name[:-4]}/article_deploy/{name}" if name.endswith(".pdf") and len(parts) == 3 else None


def first_pdf(archive: bytes) -> bytes:
    """The first PDF of a packed article."""
    with tarfile.open(fileobj=io.BytesIO(archive), mode="r:gz") as tar:
        for member in tar:
            if member.isfile() and member.name.endswith(".pdf"):
                return tar.extractfile(member).read()
    raise ValueError("no PDF in the archive")


def ask_services(lookups: DataFrame, factory: Callable[[], Fetcher]) -> DataFrame:
    """(pmcid, doi, kind, answer) of ``lookups`` (pmcid, doi, kind, url); a failure is an answer of null."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = factory()
        for frame in frames:
            answers = []
            for url in frame["url"]:
                try:
                    got = backend.get(url)
                    answers.append((got[0] if isinstance(got, tuple) else got).decode(errors="replace"))
                except Exception:
                    answers.append(None)
            yield frame[["pmcid", "doi", "kind"]].assign(answer=answers)

    return lookups.select("pmcid", "doi", "kind", "url").mapInPandas(run, "pmcid string, doi string, kind string, answer string")


FETCHED = "pmcid string, kind string, content binary, error string"


def _fetched(backend: Fetcher, kind: str, url: str, accept) -> tuple[str, bytes]:
    """(kind, content) of one address, or an error. A reader whom the archive sends on to a named PDF gets it from the publisher."""

    def get(url):
        got = backend.get(url)
        return got if isinstance(got, tuple) else (got, url)

    content, final = get(url)
    content = first_pdf(content) if kind == "archive" else content
    if kind == "pmc" and not accept(content) and "pmc.ncbi.nlm.nih.gov" in final and (other := cdn_address(final)):
        (content, _), kind = get(other), "cdn"
    if not accept(content):
        raise ValueError("not accepted")
    return kind, content


def fetch_wave(candidates: DataFrame, factory: Callable[[], Fetcher], accept=lambda b: b[:4] == b"%PDF", pauses: dict[str, float] | None = None, pause: float = 0.0, lanes: int = 1, sleep=time.sleep) -> DataFrame:
    """FETCHED: for each paper of ``candidates`` (pmcid, pos, kind, url), all of one rank, its first address that is accepted.

    A host's addresses lie in ``lanes`` tasks; each waits for what ``pauses`` says of the host (else ``pause``) times
    ``lanes`` between two of its requests, so a host sees that rate however many tasks there are. A paper's addresses at
    one host follow one another; of several hosts each may give one. Every PDF leaves the worker before the next is asked for.
    """
    host = F.coalesce(F.parse_url("url", F.lit("HOST")), F.lit(""))
    waits = pauses or {}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend, done, last, error = factory(), None, {}, None
        row = lambda *x: pd.DataFrame([x], columns=["pmcid", "kind", "content", "error"])
        now = None
        for frame in frames:
            for one in frame.itertuples(index=False):
                if (one.pmcid, one.host) != now:
                    if now and error:
                        yield row(now[0], None, None, error)
                    now, done, error = (one.pmcid, one.host), False, None
                if done:
                    continue
                left = last.get(one.host, -1e9) + waits.get(one.host, pause) * lanes - time.monotonic()
                if left > 0:
                    sleep(left)
                try:
                    kind, content = _fetched(backend, one.kind, one.url, accept)
                except Exception as e:
                    error = repr(e)
                else:
                    done, error = True, None
                    yield row(one.pmcid, kind, content, None)
                last[one.host] = time.monotonic()
        if now and error:
            yield row(now[0], None, None, error)

    rows = candidates.select("pmcid", "pos", "kind", "url", host.alias("host")).withColumn("lane", F.pmod(F.xxhash64("pmcid"), F.lit(lanes)))
    return rows.repartition("host", "lane").sortWithinPartitions("host", "lane", "pmcid", "pos", "url").mapInPandas(run, FETCHED)


def fetch_first(candidates: DataFrame, factory: Callable[[], Fetcher], accept=lambda b: b[:4] == b"%PDF", **rates) -> DataFrame:
    """FETCHED, a row a paper: the content of its first candidate by rank that is accepted, else the last error.

    One wave a rank, over papers that are still lacking: what a wave has found is stored before the next begins, so no
    address of a later rank is asked for a paper that has its PDF. ``rates`` go to ``fetch_wave``.
    """
    spark = importable(candidates.sparkSession)

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    todo, got = kept(candidates.select("pmcid", "rank", "pos", "kind", "url"), "candidates"), None
    for rank in sorted(r["rank"] for r in todo.select("rank").distinct().collect()):
        wave = todo.filter(F.col("rank") == rank)
        if got is not None:
            wave = wave.join(got.filter("content is not null").select("pmcid"), "pmcid", "left_anti")
        found = kept(fetch_wave(wave, factory, accept, **rates).withColumn("rank", F.lit(rank)), f"wave-{rank}")
        got = found if got is None else got.unionByName(found)
    if got is None:
        return spark.createDataFrame([], FETCHED)
    # One row a paper, chosen without its content: what was found, else the last error. Contents are joined by their address.
    best = got.groupBy("pmcid").agg(F.min_by(F.struct("rank", "kind", "error"), F.struct(F.col("content").isNull(), F.when(F.col("content").isNull(), -F.col("rank")).otherwise(F.col("rank")), "kind", "error")).alias("b"))
    chosen = best.select(F.col("pmcid").alias("_p"), F.col("b.rank").alias("_r"), F.col("b.kind").alias("_k"), F.col("b.error").alias("_e"))
    same = (F.col("pmcid") == F.col("_p")) & (F.col("rank") == F.col("_r")) & F.col("kind").eqNullSafe(F.col("_k")) & F.col("error").eqNullSafe(F.col("_e"))
    return got.join(chosen, same).select("pmcid", "kind", "content", "error").dropDuplicates(["pmcid"])


def downloaded(papers: DataFrame, have: DataFrame, email: str, factory: Callable[[], Fetcher], **rates) -> DataFrame:
    """(pmcid, kind, content, error) of the ``papers`` that ``have`` (pmcid) lacks: lookups, candidates, first that works.

    The error of a paper without any is pdf_download_failed: and its pmcid.
    """
    from . import acquisition

    todo = papers.join(have.select("pmcid").distinct(), "pmcid", "left_anti")
    answers = ask_services(acquisition.lookups(todo, email), factory)
    got = fetch_first(acquisition.candidates(todo, answers), factory, **rates)
    out = todo.select("pmcid").join(got, "pmcid", "left")
    return out.withColumn("error", F.when(F.col("content").isNull(), F.concat(F.lit("pdf_download_failed:"), F.col("pmcid"))))


def asked(model: VisionModel, prompt: str, image: bytes | None, sleep=time.sleep) -> tuple[str | None, str | None, float]:
    """(answer, error, seconds) of one question."""
    began, answer, error = time.monotonic(), None, None
    try:
        answer = patient(lambda: model.ask(prompt, image), sleep=sleep)
    except Exception as e:
        error = repr(e)
    return answer, error, round(time.monotonic() - began, 1)


def ask_model(prompts: DataFrame, factory: Callable[[], VisionModel], sleep=time.sleep, key: str = "item_id") -> DataFrame:
    """The ``key`` of ``prompts`` (key, prompt, image) with answer, analysis_error and elapsed_sec; an error never stops the rest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            out = []
            for name, prompt, image in frame.itertuples(index=False):
                out.append((name, *asked(model, prompt, image, sleep)))
            yield pd.DataFrame(out, columns=[key, "answer", "analysis_error", "elapsed_sec"])

    kind = prompts.schema[key].dataType.simpleString()
    return prompts.select(key, "prompt", "image").mapInPandas(run, f"{key} {kind}, answer string, analysis_error string, elapsed_sec double")


def fragments(raw) -> list[tuple[str, float]]:
    """(text, confidence) of what OCR engines give: pairs, (box, text, score), dicts, or an object with txts and scores.

    Of a tuple the first part counts. White space is collapsed, blank texts go, and what is no number is 0.
    """

    def number(x) -> float:
        try:
            return float(x or 0)
        except (TypeError, ValueError):
            return 0.0

    raw = raw[0] if isinstance(raw, tuple) and raw else raw
    if hasattr(raw, "txts"):
        scores = list(raw.scores or [])
        found = [(t, number(scores[k]) if k < len(scores) else 0.0) for k, t in enumerate(raw.txts or [])]
    else:
        found = []
        for row in raw if isinstance(raw, list) else []:
            if isinstance(row, dict):
                found.append((row.get("text") or row.get("rec_text") or "", number(row.get("confidence") or row.get("score") or row.get("rec_score"))))
            elif isinstance(row, (list, tuple)) and len(row) >= 2:
                found.append((row[1], number(row[2])) if len(row) >= 3 else (row[0], number(row[1])))
    flat = [(" ".join(str(t).split()), c) for t, c in found]
    return [(t, c) for t, c in flat if t]


def read_ocr(images: DataFrame, factory: Callable[[], Ocr]) -> DataFrame:
    """(item_id, pos, text, confidence) of every image; a backend that fails gives none for the rest of its partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            engine = factory()
        except Exception:
            engine = None
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if engine is None:
                    break
                try:
                    out += [(row.item_id, k, text, float(c)) for k, (text, c) in enumerate(fragments(engine.read(row.image)))]
                except Exception:
                    engine = None
            yield pd.DataFrame(out, columns=["item_id", "pos", "text", "confidence"])

    kind = images.schema["item_id"].dataType.simpleString()
    return images.select("item_id", "image").mapInPandas(run, f"item_id {kind}, pos int, text string, confidence double")


def read_pages(pdfs: DataFrame, factory: Callable[[], PdfReader]) -> DataFrame:
    """(paper_id, page, text, error) of PDFs (paper_id, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = factory()
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                try:
                    out += [(row.paper_id, k + 1, text, None) for k, text in enumerate(reader.pages(row.content))]
                except Exception as e:
                    out.append((row.paper_id, None, None, repr(e)))
            yield pd.DataFrame(out, columns=["paper_id", "page", "text", "error"])

    return pdfs.select("paper_id", "content").mapInPandas(run, "paper_id string, page int, text string, error string")


def white_ratio(images: DataFrame, factory: Callable[[], Callable[[bytes], tuple[int, int]]]) -> DataFrame:
    """(item_id, ratio, error): share of pixels that are almost white, counted by a backend as (white, all); a broken image has an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = factory()
        for frame in frames:
            out = []
            for name, image in frame.itertuples(index=False):
                try:
                    white, every = count(image)
                    out.append((name, white / every if every else 1.0, None))
                except Exception as e:
                    out.append((name, None, repr(e)))
            yield pd.DataFrame(out, columns=["item_id", "ratio", "error"])

    kind = images.schema["item_id"].dataType.simpleString()
    return images.select("item_id", "image").mapInPandas(run, f"item_id {kind}, ratio double, error string")


def render(regions: DataFrame, pdfs: DataFrame, factory: Callable[[], Renderer], dpi: int = 200) -> DataFrame:
    """``regions`` (paper_id, label, kind, page, box, rotated) with image (PNG), image_size and error.

    A figure's size is that of its box in points, a table's that of the image in pixels. Each PDF is read once, with
    all of its regions; a region that can't be rendered has an error and no image.
    """
    names = ("label", "kind", "page", "box", "rotated")
    rows = regions.groupBy("paper_id").agg(F.collect_list(F.struct(*names)).alias("r")).join(pdfs.select("paper_id", "content"), "paper_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = factory()
        for frame in frames:
            for paper, found, content in frame[["paper_id", "r", "content"]].itertuples(index=False):
                out = []  # a paper's images leave the worker before the next paper's are made
                for r in found:
                    box = tuple(r["box"][k] for k in ("x0", "y0", "x1", "y1"))
                    try:
                        image, *size = backend.render(content, r["page"], box, dpi, bool(r["rotated"]))
                        if r["kind"] != "table":
                            size = [round(box[2] - box[0]), round(box[3] - box[1])]
                        out.append((paper, r["label"], image, size, None))
                    except Exception as e:
                        out.append((paper, r["label"], None, None, repr(e)))
                yield pd.DataFrame(out, columns=["paper_id", "label", "image", "image_size", "error"])

    return rows.mapInPandas(run, "paper_id string, label string, image binary, image_size array<int>, error string")
