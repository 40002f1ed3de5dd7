"""A checkpoint after every item: each item of a stream is asked once, whatever is lost, and answered once.

Two records work together. The journal keeps an answer as soon as it is there, as one small file that a task writes next
to its place and then renames, so a reader sees a whole answer or none; whoever runs the item again finds it. The
stream's state, keyed by paper and label, keeps which items have been answered, so that an item that comes again
later, or a batch that is replayed, gives no second row.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folioflow.sources.backends import VisionModel, asked
from folioflow.sources.lifecycle import importable

ANSWERS = "paper string, label string, answer string, analysis_error string, elapsed_sec double"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Journal:
    """Answers by (paper, label) below a folder that all executors share. Failures are not kept: those items are asked again."""

    def __init__(self, folder: str):
        self.store, self.root = fs.FileSystem.from_uri(folder)

    def _path(self, paper: str, label: str) -> str:
        name = hashlib.sha256(json.dumps([paper, label]).encode()).hexdigest()
        return f"{self.root}/{name[:2]}/{name}.json"

    def get(self, paper: str, label: str) -> dict | None:
        path = self._path(paper, label)
        if self.store.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.store.open_input_stream(path) as file:
            return json.loads(file.read())

    def put(self, paper: str, label: str, found: dict) -> None:
        path = self._path(paper, label)
        self.store.create_dir(path.rpartition("/")[0], recursive=True)
        staged = f"{path}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(staged) as file:
            file.write(json.dumps(found).encode())
        self.store.move(staged, path)


class AskOnce(StatefulProcessor):
    """Asks the model about an item that neither the state nor the journal knows; of rows that repeat an item the first counts."""

    def __init__(self, factory: Callable[[], VisionModel], folder: str):
        self.factory, self.folder, self.model, self.journal = factory, folder, None, None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.answered = handle.getValueState("answered", "ok boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = next((f.iloc[0] for f in rows if len(f)), None)
        for _ in rows:  # all input has to be read
            pass
        if first is None or self.answered.exists():
            return
        self.journal = self.journal or Journal(self.folder)
        found = self.journal.get(*key)
        if found is None:
            self.model = self.model or self.factory()
            answer, error, seconds = asked(self.model, first["prompt"], None if first["image"] is None else bytes(first["image"]))
            found = {"answer": answer, "analysis_error": error, "elapsed_sec": seconds}
            if error is None:
                self.journal.put(*key, found)
        if found["analysis_error"] is None:
            self.answered.update((True,))
        yield pd.DataFrame([{"paper": key[0], "label": key[1], **found}], columns=["paper", "label", "answer", "analysis_error", "elapsed_sec"])

    def close(self) -> None:
        self.model = self.journal = None


def analyse_once(items: DataFrame, factory: Callable[[], VisionModel], journal: str) -> DataFrame:
    """ANSWERS for a stream of items (paper, label, prompt, image): one row an item, none asked twice once it has an answer.

    An item that failed gives its error, and is asked again if it comes again. The session must keep state in RocksDB
    (PROVIDER). ``journal`` is a folder that the driver and all executors share; it may be read as a table of answers.
    """
    spark = importable(items.sparkSession)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = items.select("paper", "label", "prompt", "image").groupBy("paper", "label")
    return rows.transformWithStateInPandas(statefulProcessor=AskOnce(factory, journal), outputStructType=ANSWERS, outputMode="Append", timeMode="None")
