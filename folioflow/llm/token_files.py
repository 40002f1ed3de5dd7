"""Token ids in Arrow files: one stream of equal-length sequences with masks, read back by position without copies.

Steps: (1) the number of shards follows from the bytes of text, their bounds are quantiles of doc_id; (2) texts are encoded,
two bytes an id where the vocabulary allows it, and go straight to their shard, sorted there; each task writes its
shard as one Arrow file: record batches of BATCH_SEQUENCES rows, each a fixed-size list of ids and one of mask bits.
Documents follow one another without gaps across sequences; only a file's last sequence is padded, and the mask is
false there. (3) The index (shard, file, doc_id, place in the shard, number of ids) is stored; it names only files of
tasks that succeeded, so a task that runs again does no harm. (4) Readers open a file as a memory map (or by ranges, in other stores), and since all batches but the
last have as many sequences of one length, a token's place says which batch and which element it is.

A doc_id that several bounds share has all shards between them, and its rows are dealt out to these by crc32 and repeats,
so a task that runs again deals them alike. The driver holds a row per shard. A task holds one batch of sequences and
one document's ids.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections import Counter
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import safe_pieces
from .common import lean, prepare, scratch, stored, text_or_empty

SEQUENCE, BATCH_SEQUENCES, END_ID = 2048, 64, 2
#: Bytes of ids that a shard has at least (where there are cores for more shards) and about at most.
LEAST_BYTES, MOST_BYTES = 2 << 20, 128 << 20
LINE_WORDS, CACHE_WORDS, CACHE_CHARS, BLOCK_BYTES = 200, 400_000, 64, 8 << 20
TOKENS = "doc_id long, ids binary, shard int"
#: Bytes of ids for a byte of text, about; and what a null doc_id counts as among the bounds.
IDS_A_BYTE, FIRST_ID = 0.5, -(1 << 63)
INDEX = "shard int, file string, doc_id long, at long, n_tokens long"
RECORDS = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Stands between words that are encoded together. It is one id, that ends a word with a zero byte, and no word without that byte has it.
MARK = "\x00"


#: A letter and the marks after it are always apart for the tokenizer, so a word's end marks are encoded on their own.
_MARKED = r"^(?P<stem>(?s:.*)[A-Za-z])(?P<tail>[.,;:!?]+)$"


class _Known:
    """Words and their ids, side by side."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def add(self, words: pa.Array, ids: pa.Array) -> None:
        """Remember short words; beyond CACHE_WORDS only these."""
        short = pc.less_equal(pc.binary_length(words), CACHE_CHARS)
        words, ids = words.filter(short), ids.filter(short)
        if len(self.words) + len(words) > CACHE_WORDS:
            self.clear()
        self.words, self.ids = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids])


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer, the id of MARK, and the remembered words (as ``_Known``)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    tok.model._resize_cache(0)  # words come once
    (mark,) = tok.encode(MARK, add_special_tokens=False).ids
    return tok, mark, _Known()


def id_type(path: str) -> np.dtype:
    """Two bytes an id if they are enough for the vocabulary, else four."""
    return np.dtype("<u2" if max(tokenizer(path)[0].get_vocab().values()) < 1 << 16 else "<u4")


def _encoded(path: str, words: pa.Array, kind: np.dtype) -> pa.Array:
    """The ids of each word as bytes, LINE_WORDS words at a time with MARK between them; words that hold MARK go one by one."""
    tok, mark, _ = tokenizer(path)
    odd = pc.match_substring(words, MARK)
    plain = pc.if_else(odd, "", words)
    starts = np.append(np.arange(0, len(words), LINE_WORDS), len(words))
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), plain.cast(pa.string())), f" {MARK} ").to_pylist()
    each = [np.array(e.ids, kind) for e in tok.encode_batch_fast([f"{line} {MARK}" for line in lines], add_special_tokens=False)]
    ids = np.concatenate([np.zeros(0, kind), *each])
    ends = np.flatnonzero(ids == mark)
    if len(ends) != len(words):
        raise ValueError("words and their ids differ in number")
    sizes = np.diff(np.append(-1, ends)) - 1
    offsets = np.cumsum(np.append(0, sizes)) * kind.itemsize
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(np.delete(ids, ends).tobytes())])
    if not pc.any(odd).as_py():
        return out
    one = lambda w: np.array(tok.encode(w, add_special_tokens=False).ids, kind).tobytes()
    return pa.array([one(w.as_py()) if o.as_py() else x.as_py() for w, o, x in zip(words, odd, out, strict=True)], pa.large_binary())


def _word_ids(path: str, words: pa.Array, kind: np.dtype) -> pa.Array:
    """The ids of each of some different words; what is remembered is not encoded again."""
    known = tokenizer(path)[2]
    found = pc.extract_regex(words, _MARKED)
    marked = found.is_valid()
    parts = pa.concat_arrays([pc.if_else(marked, found.field("stem"), words), pc.if_else(marked, found.field("tail"), pa.scalar("", pa.large_string()))])
    numbered = pc.dictionary_encode(parts)
    place = pc.index_in(numbered.dictionary, known.words)
    fresh = numbered.dictionary.filter(place.is_null())
    ids = _encoded(path, fresh, kind)
    every, at = pa.concat_arrays([known.ids, ids]), place.to_numpy(zero_copy_only=False)
    at = np.where(np.isnan(at), len(known.words) + np.cumsum(np.isnan(at)) - 1, at).astype(np.int64) if place.null_count else at
    each = every.take(pa.array(at[numbered.indices.to_numpy()]))
    known.add(fresh, ids)
    return pc.binary_join_element_wise(each[: len(words)], each[len(words) :], pa.scalar(b"", pa.large_binary()))


def _batch_ids(path: str, texts: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after the other, and where each text's begin (and the last one's end).

    The tokenizer drops white space and never joins what it separates, so Arrow cuts texts at white space and numbers the
    words, and each different word of the batch is looked up or encoded once.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    numbered = pc.dictionary_encode(lists.values)
    if not len(numbered):
        return np.zeros(0, kind), np.zeros(len(texts) + 1, np.int64)
    taken = _word_ids(path, numbered.dictionary, kind).take(numbered.indices)
    bounds = np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1) // kind.itemsize
    raw = taken.buffers()[2]
    return np.frombuffer(raw, kind, bounds[-1]) if raw else np.zeros(0, kind), bounds[lists.offsets.to_numpy()]


def text_ids(path: str, texts: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """As ``_batch_ids``, with texts of more than BLOCK_BYTES in parts cut at white space, so that its tables stay small."""
    if texts.nbytes <= 2 * BLOCK_BYTES:
        return _batch_ids(path, texts, kind)
    each = [np.concatenate([_batch_ids(path, pa.array([part]), kind)[0] for part in safe_pieces(t.as_py(), BLOCK_BYTES // 2)]) for t in texts]
    return np.concatenate(each), np.cumsum([0, *map(len, each)])


def shard_bounds(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2) -> np.ndarray:
    """The doc_ids at which new shards begin: quantiles, as many as the texts' bytes are worth."""
    size = df.agg(F.sum(F.octet_length(F.col(text)) + F.lit(1))).first()[0] or 0
    shards = tasks_for(df.sparkSession, int(size * IDS_A_BYTE * width / 2))
    if shards == 1:
        return np.zeros(0, np.int64)
    at = F.percentile_approx(F.coalesce(F.col(key).cast("long"), F.lit(FIRST_ID)), [k / shards for k in range(1, shards)], max(10_000, 10 * shards))
    return np.array(df.agg(at).first()[0] or [], np.int64)


class Dealer:
    """The shard of each row; rows of a doc_id with several shards go round them, beginning at their ids' crc32."""

    def __init__(self, bounds: np.ndarray):
        self.bounds, self.seen = bounds, Counter()

    def shards(self, keys: list, rows: list[bytes]) -> list[int]:
        values = np.array([FIRST_ID if k is None else k for k in keys], np.int64)
        low, high = (np.searchsorted(self.bounds, values, side) for side in ("left", "right"))
        out = low.tolist()
        for k in np.flatnonzero(high > low).tolist():
            name = (keys[k], zlib.crc32(rows[k]))
            out[k] += (name[1] + self.seen[name]) % int(high[k] - low[k] + 1)
            self.seen[name] += 1
        return out


def encoded(df: DataFrame, path: str, bounds: np.ndarray, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """TOKENS: every text's ids and ``end_id``, and its shard by ``bounds``."""

    @lean("token files", tokenizer.cache_clear)
    def run(batches):
        kind = id_type(path)
        end, dealer = np.array([end_id], kind), Dealer(bounds)
        for batch in batches:
            ids, offsets = text_ids(path, batch.column(1), kind)
            rows = [np.append(ids[a:b], end).tobytes() for a, b in pairwise(offsets.tolist())]
            shards = dealer.shards(batch.column(0).to_pylist(), rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), pa.array(shards, pa.int32())], ["doc_id", "ids", "shard"])

    return df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(run, TOKENS)


class ShardWriter:
    """One Arrow file of sequences; documents are appended, ``close`` pads the last sequence."""

    def __init__(self, uri: str, kind: np.dtype, length: int, rows: int):
        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.kind, self.length, self.rows, self.size, self.pending, self.waiting = kind, length, rows, 0, [], 0
        row = lambda value: pa.list_(pa.field("item", value, nullable=False), length)
        fields = [pa.field("ids", row(pa.from_numpy_dtype(kind)), nullable=False), pa.field("mask", row(pa.bool_()), nullable=False)]
        self.schema = pa.schema(fields, metadata={"length": str(length), "batch": str(rows)})
        self.file = store.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.file, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.size += len(ids)
        self.waiting += len(ids)
        full = self.rows * self.length
        if self.waiting >= full:
            joined = np.concatenate(self.pending)
            done = len(joined) // full * full
            for k in range(0, done, full):
                self._write(joined[k : k + full], full)
            self.pending, self.waiting = [joined[done:]], len(joined) - done

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        columns = [pa.FixedSizeListArray.from_arrays(v, type=f.type) for v, f in zip((pa.array(ids), mask), self.schema, strict=True)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            ids = np.concatenate(self.pending)
            self._write(np.append(ids, np.zeros(-len(ids) % self.length, self.kind)), len(ids))
        self.writer.close()
        self.file.close()


class Sequences:
    """Random access to the sequences of one file; in a local file ids are views of the memory map."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        self.file = (fs.LocalFileSystem(use_mmap=True) if isinstance(store, fs.LocalFileSystem) else store).open_input_file(path)
        self.reader = pa.ipc.open_file(self.file)
        self.length, self.rows = (int(self.reader.schema.metadata[k]) for k in (b"length", b"batch"))
        self._held = (-1, None)

    def _batch(self, k: int):
        if self._held[0] != k:
            self._held = (k, self.reader.get_batch(k))
        return self._held[1]

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * self.rows + self._batch(n - 1).num_rows if n else 0

    def ids(self, k: int) -> np.ndarray:
        batch = self._batch(k // self.rows)
        return batch.column(0).values.to_numpy()[k % self.rows * self.length :][: self.length]

    def mask(self, k: int) -> pa.Array:
        return self._batch(k // self.rows).column(1).values.slice(k % self.rows * self.length, self.length)

    def tokens(self, at: int, n: int):
        """Views of the ``n`` ids from place ``at`` on, one for each batch they lie in; a mask bit that is false there is an error."""
        full = self.rows * self.length
        while n:
            batch, first = self._batch(at // full), at % full
            part = min(n, full - first)
            view = batch.column(0).values.to_numpy()[first : first + part]
            if len(view) < part or not batch.column(1).values[first + part - 1].as_py():
                raise ValueError("the file ends before the document")
            yield view
            at, n = at + part, n - part

    def close(self) -> None:
        self._held = (-1, None)
        self.file.close()


def write_files(tokens: DataFrame, folder: str, kind: np.dtype, shards: int, length: int = SEQUENCE, rows: int = BATCH_SEQUENCES) -> DataFrame:
    """INDEX of the documents written, in ascending order of doc_id (null first), shard, crc32 of ids, length. Evaluate it once only."""
    order = [F.asc_nulls_first("doc_id"), F.crc32("ids"), F.octet_length("ids")]

    def run(batches):
        shard, name, out = TaskContext.get().partitionId(), f"{folder}/{uuid.uuid4().hex}.arrow", None
        try:
            for batch in batches:
                at, sizes = [], []
                for value in batch.column(1):
                    out = out or ShardWriter(name, kind, length, rows)
                    ids = np.frombuffer(value.as_py(), kind)
                    at.append(out.size)
                    sizes.append(len(ids))
                    out.add(ids)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int32()), pa.array([name] * n, pa.string()), batch.column(0), pa.array(at, pa.int64()), pa.array(sizes, pa.int64())], ["shard", "file", "doc_id", "at", "n_tokens"])
        finally:
            if out is not None:
                out.close()

    dealt = tokens.repartitionById(shards, F.col("shard")).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(run, INDEX)


def read_files(index: DataFrame, width: int = 2) -> DataFrame:
    """RECORDS of the documents that the stored ``index`` names, read from the files; ``width``: bytes of an id, for dealing out tasks."""
    shards = {r["shard"]: (r["file"], r["n"]) for r in index.groupBy("shard").agg(F.max("file").alias("file"), F.sum("n_tokens").alias("n")).collect()}
    names, total = {}, 0
    for shard, (file, n) in sorted(shards.items()):
        names[shard] = (file, total)
        total += n
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(names)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def run(batches):
        now, held = None, None
        for batch in batches:
            rows = ([], [], [], [])
            for shard, doc, at, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                file, before = shared.value[shard]
                if now != shard:
                    if held is not None:
                        held.close()
                    now, held = shard, Sequences(file)
                crc = 0
                for view in held.tokens(at, n):
                    crc = zlib.crc32(view.astype("<u4", copy=False), crc)
                for column, value in zip(rows, (doc, before + at, n, crc), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])
        if held is not None:
            held.close()

    dealt = index.select("shard", "doc_id", "at", "n_tokens").repartitionByRange(tasks_for(spark, total * width), "shard", "at").sortWithinPartitions("shard", "at")
    return dealt.mapInArrow(run, RECORDS)


def tasks_for(spark, size: int) -> int:
    return max(1, min(2 * spark.sparkContext.defaultParallelism, -(-size // LEAST_BYTES)), -(-size // MOST_BYTES))


def write_documents(df: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID, length: int = SEQUENCE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored INDEX of the files of all documents, by the tokenizer at ``path``.

    A null or empty text has the end alone. A null doc_id comes first; rows that share one follow by shard, crc32 and number
    of their ids, and rows that repeat are each written. Other columns, whatever their names, are not read; an empty
    table has an empty index and no files.
    """
    spark = prepare(df.sparkSession)
    kind = id_type(path)
    bounds = shard_bounds(df, key, text, kind.itemsize)
    tokens = encoded(df, path, bounds, end_id, key, text)
    return stored(write_files(tokens, folder or scratch(spark, "token-files"), kind, len(bounds) + 1, length), "token-index")
