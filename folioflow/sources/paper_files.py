"""A sink of files, one folder a paper, that shows all files of a write or none.

A Python data source with a two-phase commit: tasks write their files below a staging folder of their own, the driver
moves them to their places when all tasks have succeeded, and deletes the staging folders otherwise. A task that is run
again stages anew; what its first run has left behind goes with the staging folder. File names reach the driver, contents never.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .lifecycle import importable

ROW = "paper string, name string, content binary"
STAGING = "_staging"


@dataclass
class Staged(WriterCommitMessage):
    """A task's folder and its files (paper, name)."""

    folder: str
    files: list[tuple[str, str]]


class PaperFilesWriter(DataSourceWriter):
    def __init__(self, uri: str):
        self.uri, self.job = uri.rstrip("/"), uuid.uuid4().hex

    def _store(self):
        return fs.FileSystem.from_uri(self.uri)

    def write(self, iterator: Iterator) -> Staged:
        store, root = self._store()
        folder = f"{STAGING}/{self.job}/{uuid.uuid4().hex}"
        files = []
        for number, row in enumerate(iterator):
            for part in (row.paper, row.name):
                if not part or "/" in part or part in (".", "..", STAGING):
                    raise ValueError(f"no name of a folder or file: {part!r}")
            if not number:
                store.create_dir(f"{root}/{folder}", recursive=True)
            with store.open_output_stream(f"{root}/{folder}/{number}") as file:
                file.write(bytes(row.content or b""))
            files.append((row.paper, row.name))
        return Staged(folder, files)

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = self._store()
        made = set()
        for message in messages:
            for number, (paper, name) in enumerate(message.files if message else ()):
                if paper not in made:
                    store.create_dir(f"{root}/{paper}", recursive=True)
                    made.add(paper)
                store.move(f"{root}/{message.folder}/{number}", f"{root}/{paper}/{name}")
        self._clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        store, root = self._store()
        staged = f"{root}/{STAGING}/{self.job}"
        if store.get_file_info(staged).type == fs.FileType.Directory:
            store.delete_dir(staged)
        above = f"{root}/{STAGING}"
        if store.get_file_info(above).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(above)):
            store.delete_dir(above)


class PaperFiles(DataSource):
    """``df.write.format("paper_files").mode("append").save(uri)`` for rows (paper, name, content)."""

    @classmethod
    def name(cls) -> str:
        return "paper_files"

    def schema(self) -> str:
        return ROW

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return PaperFilesWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    importable(spark).dataSource.register(PaperFiles)


def write_files(files: DataFrame, uri: str) -> None:
    """Write rows (paper, name, content) to ``uri``/paper/name; a file that is there already is replaced at the commit."""
    register(files.sparkSession)
    files.select("paper", "name", F.col("content").cast("binary").alias("content")).write.format("paper_files").mode("append").save(uri)


def read_files(spark: SparkSession, uri: str, name: str = "*") -> DataFrame:
    """(paper, name, content) of the files below ``uri``."""
    rows = spark.read.format("binaryFile").load(f"{uri.rstrip('/')}/*/{name}")
    return rows.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("paper"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content")


def envelope_files(envelopes: DataFrame, paper: str, name: str) -> DataFrame:
    """Rows to write of ``papers.enveloped``: one JSON file a paper."""
    return envelopes.select(F.col(paper).cast("string").alias("paper"), F.lit(name).alias("name"), F.encode("document", "UTF-8").alias("content"))


def image_files(rendered: DataFrame, names: DataFrame) -> DataFrame:
    """Rows to write of rendered regions (paper_id, label, image): PNGs under the names (paper_id, label, name); failed ones go."""
    rows = rendered.filter("image is not null").join(names, ["paper_id", "label"])
    return rows.select(F.col("paper_id").alias("paper"), "name", F.col("image").alias("content"))


def context_files(papers: DataFrame) -> DataFrame:
    """Rows to write of papers (pmcid, doi, title, text_clean): context.json, and paper.txt where there is a text."""
    meta = papers.select(F.col("pmcid").alias("paper"), F.lit("context.json").alias("name"), F.encode(F.to_json(F.struct("pmcid", "doi", "title")), "UTF-8").alias("content"))
    text = papers.filter("text_clean <> ''").select(F.col("pmcid").alias("paper"), F.lit("paper.txt").alias("name"), F.encode("text_clean", "UTF-8").alias("content"))
    return meta.unionByName(text)
