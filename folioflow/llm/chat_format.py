"""Event-sourced chat formatting.

A log of events (conv_id, seq, turn, kind, role, text, and item if turns share a number) is partitioned by conversation, sorted by sequence and
folded into final messages, which a template renders. Kinds: ``start`` opens a turn with its role and perhaps text,
``delta`` appends, ``edit`` replaces the whole text, ``regenerate`` empties the turn for new deltas, ``delete``
removes the turn. Conversations are folded and rendered in blocks of ``BLOCK_TURNS`` turns, so that one very long
conversation is spread over tasks; only what must see a conversation in order (its digests) streams over the
finished blocks, holding one block at a time.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TURNS = 256
ARROW_ROWS = 1_000
OPEN, CLOSE = "### ", "</turn>\n"
ASSISTANT = "assistant"
BLOCKS = "conv_id long, block long, formatted string, loss array<struct<start:int,stop:int>>, turns int"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Put a backslash before each backslash and control string."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return re.sub(r":", r"\\:", escape(role))


def fold(events) -> list[tuple[int, str, str]]:
    """(turn, role, text) of the turns that remain, by turn, role and text; ``events`` are (turn, item, kind, role, text) in sequence.

    Events of one turn and item make a turn.
    """
    turns: dict = {}
    for turn, item, kind, role, text in events:
        if kind == "delete":
            turns.pop((turn, item), None)
            continue
        now = turns.setdefault((turn, item), [role or "", []])
        if role and kind in ("start", "edit"):
            now[0] = role
        if kind in ("edit", "regenerate"):
            now[1] = []
        if text:
            now[1].append(text)
    return sorted(((t, role, "".join(parts)) for (t, _), (role, parts) in turns.items()), key=lambda x: (x[0] is not None, *x))


def render(turns, trained: str = ASSISTANT) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of a block, and the spans (code points) that the loss mask covers."""
    out, spans, at = [], [], 0
    for _, role, text in turns:
        head, body = f"{OPEN}{escape_role(role)}: ", escape(text)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(head + body + CLOSE)
        at += len(out[-1])
    return "".join(out), spans


def _unescaped(text: str, what: str, at: int) -> int:
    """Where ``what`` stands next with an even number of backslashes before it; -1 if nowhere."""
    while (found := text.find(what, at)) >= 0:
        before = found
        while before > at and text[before - 1] == "\\":
            before -= 1
        if (found - before) % 2 == 0:
            return found
        at = found + 1
    return -1


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; the inverse of ``render``. An error if the text isn't wholly made of turns."""
    out, at = [], 0
    while at < len(formatted):
        head = at + len(OPEN)
        colon = _unescaped(formatted, ":", head) if formatted.startswith(OPEN, at) else -1
        end = _unescaped(formatted, CLOSE[:-1], colon + 2) if colon >= 0 and formatted.startswith(": ", colon) else -1
        if end < 0 or not formatted.startswith(CLOSE, end):
            raise ValueError(f"no turn at {at}")
        out.append((unescape(formatted[head:colon]), unescape(formatted[colon + 2 : end])))
        at = end + len(CLOSE)
    return out


def _rows(batches):
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _emit(rows, names, kinds):
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def format_chats(events: DataFrame, trained: str = ASSISTANT, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """BLOCKS: the formatted text of each conversation, a row for every ``block_turns`` turns.

    Events of one sequence number are taken by ``part`` (if there is such a column), kind (start, deltas, others), role and
    text, so ties and repeated rows give a defined order; a null turn is a turn before all others, a null text is empty, a null role the empty
    role, a null kind a delta, and a null conv_id a conversation of its own. Without a column ``item`` all events of a turn
    belong together. Other columns are not read.
    """
    rank = F.when(F.col("kind") == "start", 0).when(F.col("kind") == "delta", 1).otherwise(2)
    item, part = (F.col(c).cast("long") if c in events.columns else F.lit(None).cast("long") for c in ("item", "part"))
    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.floor(F.col("turn").cast("long") / F.lit(block_turns)).cast("long").alias("block"),
        F.col("seq").cast("long").alias("seq"), part.alias("part"), rank.alias("rank"), F.col("turn").cast("long").alias("turn"), item.alias("item"), F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    log = log.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "seq", "part", "rank", "turn", "role", "text", "item")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.int32())
    names = ["conv_id", "block", "formatted", "loss", "turns"]

    def run(batches):
        def done(key, events):
            turns = fold(events)
            text, spans = render(turns, trained)
            return (*key, text, [{"start": a, "stop": b} for a, b in spans], len(turns))

        key, mine, out, size = None, [], [], 0
        for conv, block, _, _, turn, item, kind, role, text in _rows(batches):
            if key is not None and key != (conv, block):
                out.append(done(key, mine))
                size += len(out[-1][2])
                mine = []
                if len(out) >= ARROW_ROWS or size > 1 << 22:
                    yield _emit(out, names, kinds)
                    out, size = [], 0
            key = (conv, block)
            mine.append((turn, item, kind, role, text))
        if key is not None:
            out.append(done(key, mine))
        if out:
            yield _emit(out, names, kinds)

    return log.select("conv_id", "block", "seq", "rank", "turn", "item", "kind", "role", "text").mapInArrow(run, BLOCKS)


def read_back(blocks: DataFrame) -> DataFrame:
    """DIGESTS of every conversation, taken from the formatted text and its loss spans alone.

    Blocks stream by conversation and block; hashes run along, so memory is bounded by one block.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    ordered = blocks.select("conv_id", "block", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "block")

    def run(batches):
        conv, state, out = None, None, []
        for one, _, formatted, loss in _rows(batches):
            if state is None or conv != one:
                if state is not None:
                    out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                if len(out) >= ARROW_ROWS:
                    yield _emit(out, names, kinds)
                    out = []
                conv, state = one, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"] : span["stop"]])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(formatted)
        if state is not None:
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
        if out:
            yield _emit(out, names, kinds)

    return ordered.mapInArrow(run, DIGESTS)


def events_of_turns(turns: DataFrame, delta_chars: int = 2_000) -> DataFrame:
    """The event log of finished conversations (rows by turn): a start event and deltas of ``delta_chars`` characters.

    Rows that repeat a turn stay turns of their own, named by ``item``, and follow one another by role and text.
    """
    text = F.coalesce("text", F.lit(""))
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))  # in one go over the text
    rows = turns.withColumn("item", F.monotonically_increasing_id())
    rows = rows.select("conv_id", "item", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.posexplode(F.when(text == "", F.array(F.lit(""))).otherwise(cut)).alias("part", "text"))
    return rows.select("conv_id", F.col("turn").alias("seq"), "part", "turn", F.when(F.col("part") == 0, "start").otherwise("delta").alias("kind"), "role", "text", "item")
