"""Best-fit packing of tokenised documents by bin completion.

Three steps: (1) every document becomes pieces of at most ``capacity`` tokens, stored in the shared folder;
(2) the driver plans on the histogram of piece lengths, which has at most ``capacity`` entries whatever the corpus;
(3) every piece gets its rank among the pieces of its length and reads its place off the plan. Only the plan's
entries are broadcast; their number follows from the distinct lengths, not from the pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from functools import lru_cache
from itertools import chain, count, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import SPACE, safe_pieces
from .common import lean, stored, text_or_empty

CAPACITY = 2048
#: Nodes of one search for a filling, of the search over whole plans, and the pieces that share a ranking cell.
FILL_NODES, PLAN_TRIES, CELL_ROWS = 4_000, 12, 50_000
CACHE_WORDS, CACHE_CHARS, LINE_WORDS, BLOCK_BYTES, WIDE_BYTES = 400_000, 64, 50, 4 << 20, 1 << 28

# A word is white space with the run after it, less full stops and the like: cutting before white space that follows
# another character is always safe, and so is cutting between a letter and a mark that isn't an apostrophe.
_CUTS = (f"([^{SPACE}])([{SPACE}])", "([A-Za-z])([.,;:!?])")
# Where no two spaces stand together, a space needs no look at what is before it.
_TWO_SPACES, _OTHER_SPACE = f"[{SPACE}][{SPACE}]", (f"([^{SPACE}])([{SPACE.replace(' ', '')}])", _CUTS[1])
_ONE_SPACE = f"^[ \n][^{SPACE}]+$"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Known:
    """Words and their ids, side by side, from the oldest to the newest."""

    def __init__(self):
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def __len__(self) -> int:
        return len(self.words)

    def add(self, words: pa.Array, ids: pa.Array) -> None:
        """Remember short words; beyond CACHE_WORDS only the newer half of all."""
        short = pc.less_equal(pc.binary_length(words), CACHE_CHARS)
        both = ((self.words, words.filter(short).cast(pa.string())), (self.ids, ids.filter(short).cast(pa.binary())))
        many = len(self) + short.true_count
        kept = CACHE_WORDS // 2 if many > CACHE_WORDS else many
        self.words, self.ids = (pa.concat_arrays([old.slice(min(len(old), many - kept)), new.slice(max(0, many - kept - len(old)))]) for old, new in both)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The tokenizer, which ids begin with a space or line break, and the remembered words (as ``_Known``)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    spaced = np.zeros(1 + max(tok.get_vocab().values()), bool)
    spaced[[i for token, i in tok.get_vocab().items() if token.startswith(("\u0120", "\u010a"))]] = True  # as byte-level BPE writes them
    tok.model._resize_cache(0)  # words come once
    return tok, spaced, _Known()


def _encoded(path: str, words: pa.Array) -> pa.Array:
    """Each word's ids; words of a space or line break and then no other white space are encoded many at once.

    These two are found at a token's start only, so in a line of such words an id that begins with one begins a word.
    """
    tok, spaced, _ = _tokenizer(path)
    kind = pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary()
    at = np.flatnonzero(pc.match_substring_regex(words, _ONE_SPACE).to_numpy(zero_copy_only=False))
    lines = np.append(np.arange(0, len(at), LINE_WORDS), len(at))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(lines), words.take(pa.array(at))), pa.scalar("", words.type)).to_pylist()
    each = [np.array(e.ids, "<u4") for e in tok.encode_batch_fast(joined, add_special_tokens=False)]
    ids, sizes = np.concatenate([np.zeros(0, "<u4"), *each]), np.array([len(x) for x in each], np.int64)
    begin, ends = spaced[ids], np.cumsum(sizes)
    sound = (np.diff(np.append(0, np.append(0, np.cumsum(begin))[ends])) == np.diff(lines)) & begin[ends - sizes]
    ids, at = ids[np.repeat(sound, sizes)], at[np.repeat(sound, np.diff(lines))]
    offsets = (4 * np.append(np.flatnonzero(spaced[ids]), len(ids))).astype("<i8" if kind == pa.large_binary() else "<i4")
    many = pa.Array.from_buffers(kind, len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])
    alone = np.delete(np.arange(len(words)), at)
    rest = tok.encode_batch_fast(words.take(pa.array(alone)).to_pylist(), add_special_tokens=False)
    place = np.empty(len(words), np.int64)
    place[np.append(at, alone)] = np.arange(len(words))
    return pa.concat_arrays([many, pa.array([np.array(e.ids, "<u4").tobytes() for e in rest], kind)]).take(pa.array(place))


def _batch_ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after the other, and where each text's begin (and the last one's end).

    Texts are cut into words, and these numbered and looked up among the remembered ones, by Arrow; only the others are encoded.
    """
    known = _tokenizer(path)[2]
    # Offsets of four bytes reach, unless a text has a giant run that can't be cut; what is used up goes at once.
    wide = texts.nbytes > WIDE_BYTES
    texts = texts.cast(pa.large_string() if wide else pa.string())
    # A mark that is in no text; none of them begins as it ends, so with text around it stays the only one at its place.
    mark = next(m for m in chain(["\x00"], (f"\x00{n}\x01" for n in count())) if not pc.any(pc.match_substring(texts, m)).as_py())
    cuts = _CUTS
    if not pc.any(pc.match_substring_regex(texts, _TWO_SPACES)).as_py():
        texts, cuts = pc.replace_substring(texts, " ", f"{mark} "), _OTHER_SPACE
    for cut in cuts:
        texts = pc.replace_substring_regex(texts, cut, f"\\1{mark}\\2")
    lists = pc.split_pattern(texts, mark)
    del texts
    numbered, ends = pc.dictionary_encode(lists.values), lists.offsets.to_numpy()
    del lists
    words, codes = numbered.dictionary, numbered.indices
    del numbered
    found = pc.index_in(words, value_set=known.words.cast(words.type))
    fresh, new = words.filter(found.is_null()), found.is_null().to_numpy(zero_copy_only=False)
    del words
    ids = _encoded(path, fresh)
    place = np.where(new, len(known) + np.cumsum(new) - 1, found.fill_null(0).to_numpy())
    taken = pa.concat_arrays([known.ids.cast(ids.type), ids]).take(pa.array(place)).take(codes)
    known.add(fresh, ids)
    del fresh, ids
    bounds = np.frombuffer(taken.buffers()[1], "<i8" if wide else "<i4", len(taken) + 1).take(ends) // 4
    raw = taken.buffers()[2]
    return np.frombuffer(raw, "<u4", bounds[-1]) if raw else np.zeros(0, "<u4"), bounds


def _text_ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``_batch_ids``, with texts of more than BLOCK_BYTES in parts, so that its tables stay small."""
    if texts.nbytes <= 2 * BLOCK_BYTES:
        return _batch_ids(path, texts)
    each = [np.concatenate([_batch_ids(path, pa.array([part]))[0] for part in safe_pieces(t.as_py(), BLOCK_BYTES // 2)]) for t in texts]
    return np.concatenate(each), np.cumsum([0, *map(len, each)])


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """(first row, rows) of stretches of about BLOCK_BYTES; a longer text ends its stretch."""
    block = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // BLOCK_BYTES
    starts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    return [(a, b - a) for a, b in pairwise(starts) if b > a]


def token_pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """PIECES: a document's ids and ``end_id``, cut into pieces of ``capacity`` if it is longer; the first may be shorter.

    Null and empty texts are one piece of one token.
    """

    def cut(keys, texts):
        rows = ([], [], [], [], [])
        ids, bounds = _text_ids(path, texts)
        for one, first, last in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            raw = ids[first:last].tobytes() + int(end_id).to_bytes(4, "little")
            n = len(raw) // 4
            start, piece = 0, 0
            while start < n:
                size = min(n, n % capacity or capacity) if start == 0 else capacity
                for column, value in zip(rows, (one, piece, start, size, zlib.crc32(raw[4 * start : 4 * (start + size)])), strict=True):
                    column.append(value)
                start, piece = start + size, piece + 1
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    @lean("packing", _tokenizer.cache_clear)
    def run(batches):
        for batch in batches:
            for start, n in _slices(batch.column(1)):
                yield cut(batch.column(0).slice(start, n).to_pylist(), batch.column(1).slice(start, n))

    return df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(run, PIECES)


def completions(counts: list[int], room: int, want: int = 1, most_nodes: int = FILL_NODES) -> list[tuple[int, ...]]:
    """Fillings of ``room`` by available lengths, best first: least waste, then fewest and so largest pieces.

    ``counts[l]`` pieces have length l. A branch is cut when even filling up all that is left could not waste less
    than the worst kept filling. Fillings are met from few large pieces to many small ones; of two with the same
    sum, the one met first dominates: splitting a piece of it gives the other.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    sizes = [l for l in range(min(room, len(counts) - 1), 0, -1) if counts[l]]
    if not sizes:
        return [()]
    ascending = sizes[::-1]
    smallest, nodes = ascending[0], 0

    def offer(waste: int, chosen: tuple[int, ...]) -> None:
        if all(waste != w for w, _ in found):
            found.append((waste, chosen))
            found.sort(key=lambda x: (x[0], len(x[1])))
            del found[want:]

    # The incumbent: best fit, with as many pieces as fit.
    chosen, left = (), room
    for size in sizes:
        fits = min(left // size, counts[size])
        chosen, left = (*chosen, *[size] * fits), left - size * fits
    offer(left, chosen)
    for most in range(1, 7):
        if len(found) >= want and found[-1][0] == 0:
            break
        budget = nodes + most_nodes // 6

        def search(left: int, top: int, chosen: tuple[int, ...], most: int, budget: int) -> None:
            nonlocal nodes
            nodes += 1
            if left < smallest or most == 0:
                offer(left, chosen)
                return
            at = bisect_right(ascending, min(left, top)) - 1
            while at >= 0 and nodes < budget:
                size = ascending[at]
                at -= 1
                if chosen.count(size) >= counts[size]:
                    continue
                if most == 1:  # the largest that fits wastes least
                    nodes += 1
                    offer(left - size, (*chosen, size))
                    return
                if size * most < left and len(found) == want and left - size * most >= found[-1][0]:
                    return
                search(left - size, size, (*chosen, size), most - 1, budget)
                if len(found) == want and found[-1][0] == 0 or want == 1 and found and found[0][0] == 0:
                    return

        search(room, room, (), most, budget)
    return [c for _, c in found] or [()]


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on the histogram: the largest piece, then again and again the largest that still fits."""
    counts = [0] * (capacity + 1)
    for size, n in histogram.items():
        counts[size] = n
    out = []
    ascending = [l for l in range(1, capacity + 1) if counts[l]]
    while ascending:
        chosen, left = [], capacity
        used: dict[int, int] = {}
        at = len(ascending) - 1
        while at >= 0:
            size = ascending[at]
            fits = min(left // size, counts[size] - used.get(size, 0))
            if fits:
                chosen += [size] * fits
                used[size] = fits
                left -= size * fits
            at = min(at, bisect_right(ascending, left)) - 1
        times = min(counts[s] // n for s, n in used.items())
        for s, n in used.items():
            counts[s] -= n * times
        ascending = [l for l in ascending if counts[l]]
        out.append((tuple(chosen), times))
    return out


def complete(histogram: dict[int, int], capacity: int, turn: dict[int, int] | None = None, limit: int | None = None, nodes: int = FILL_NODES) -> list[tuple[tuple[int, ...], int]] | None:
    """One plan by bin completion; ``turn`` takes another than the first filling at some steps.

    None as soon as the bins used and the least number for the rest (its tokens over the capacity) reach ``limit``.
    """
    counts = [0] * (capacity + 1)
    for size, n in histogram.items():
        counts[size] = n
    left = sum(s * n for s, n in histogram.items())
    out, bins, top, step = [], 0, capacity, 0
    while left:
        while not counts[top]:
            top -= 1
        counts[top] -= 1
        other = (turn or {}).get(step, 0)
        fillings = completions(counts, capacity - top, other + 1, nodes)
        filling = fillings[min(other, len(fillings) - 1)]
        counts[top] += 1
        chosen = (top, *filling)
        need = {s: chosen.count(s) for s in chosen}
        times = min(counts[s] // n for s, n in need.items())
        for s, n in need.items():
            counts[s] -= n * times
        out.append((chosen, times))
        bins, left, step = bins + times, left - sum(chosen) * times, step + 1
        if limit is not None and bins + -(-left // capacity) >= limit:
            return None
    return out


def dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces of ``other`` fit into those of ``one``, several into one if need be (Martello and Toth).

    Where ``other`` stands, ``one`` can stand as well: each of its pieces changes places with what fits into it.
    """
    if sum(other) > sum(one):
        return False
    if not other:
        return True
    for k, size in enumerate(one):
        if size >= other[0] and size not in one[:k] and dominates((*one[:k], size - other[0], *one[k + 1 :]), other[1:]):
            return True
    return False


def undominated(counts: list[int], room: int) -> list[tuple[int, ...]]:
    """All fillings of ``room`` that no other dominates, best first (least waste, then fewest pieces)."""
    sizes, found = [l for l in range(min(room, len(counts) - 1), 0, -1) if counts[l]], []

    def search(at: int, left: int, chosen: tuple[int, ...]) -> None:
        if at == len(sizes):
            found.append(chosen)
            return
        size = sizes[at]
        for n in range(min(left // size, counts[size]), -1, -1):
            search(at + 1, left - n * size, (*chosen, *[size] * n))

    search(0, room, ())
    found.sort(key=lambda c: (-sum(c), len(c)))
    kept: list[tuple[int, ...]] = []
    for c in found:
        if not any(dominates(k, c) for k in kept):
            kept.append(c)
    return kept


def least_bins(histogram: dict[int, int], capacity: int, incumbent: list[tuple[tuple[int, ...], int]]) -> list[tuple[tuple[int, ...], int]]:
    """A plan with the least number of bins there is: branch and bound over all undominated fillings of every bin.

    The time grows exponentially with the pieces; ``plan`` is for corpora.
    """
    counts = [0] * (capacity + 1)
    for size, n in histogram.items():
        counts[size] = n
    best, bins = incumbent, sum(n for _, n in incumbent)

    def search(left: int, chosen: list[tuple[int, ...]]) -> None:
        nonlocal best, bins
        if not left:
            best, bins = [(c, 1) for c in chosen], len(chosen)
            return
        if len(chosen) + -(-left // capacity) >= bins:  # even without further waste no better than the incumbent
            return
        top = max(l for l in range(1, capacity + 1) if counts[l])
        counts[top] -= 1
        for filling in undominated(counts, capacity - top):
            for size in filling:
                counts[size] -= 1
            search(left - top - sum(filling), [*chosen, (top, *filling)])
            for size in filling:
                counts[size] += 1
        counts[top] += 1

    search(sum(s * n for s, n in histogram.items()), [])
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY, tries: int = PLAN_TRIES, nodes: int = FILL_NODES, exact: bool = False) -> list[tuple[tuple[int, ...], int]]:
    """(piece lengths, how often) for as few bins as the search finds.

    Best fit is the first incumbent; bin completion (``nodes`` for one filling) and then ``tries`` variants of it, each
    with another filling at one step, follow while they can still beat the incumbent, each cut off by the waste bound.
    The steps are spread over the first half of the plan, where fillings are still many. It ends early at the lower
    bound. With ``exact`` it goes on until the number is proven to be the least (``least_bins``; for small inputs).
    """
    if not histogram:
        return []
    best = best_fit(histogram, capacity)
    total = lambda p: sum(n for _, n in p)
    least = -(-sum(s * n for s, n in histogram.items()) // capacity)
    steps = 0
    for attempt in range(tries + 1):
        if total(best) == least:
            break
        at = (attempt - 1) * max(1, steps // (2 * tries)) if attempt else None
        found = complete(histogram, capacity, {at: 1} if attempt else None, total(best) if attempt else None, nodes)
        if found is not None:
            steps = steps or len(found)
            if total(found) < total(best):
                best = found
    return least_bins(histogram, capacity, best) if exact and total(best) > least else best


def entries(packed: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Columns length, first rank, first bin, pieces of this length a bin, first offset; sorted by length and rank."""
    rows, seen, first = [], {}, 0
    for chosen, times in packed:
        offset = 0
        for size in sorted(set(chosen), reverse=True):
            each = chosen.count(size)
            rows.append((size, seen.get(size, 0), first, each, offset))
            seen[size] = seen.get(size, 0) + each * times
            offset += size * each
        first += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """``pieces`` with rank (from 0) among those of the same length, without a task that holds a whole length.

    Each length is dealt out to cells by ``_spread``, a number that rows have been stored with, so rows that repeat a key are
    dealt out too; a cell's rows are numbered, and the cells' counts give each cell its start.
    """
    cells = max(8, -(-rows // CELL_ROWS))
    cell = pieces.withColumn("_cell", F.pmod("_spread", F.lit(cells))).drop("_spread")
    order = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    base = cell.groupBy("length", "_cell").count().withColumn("_base", F.coalesce(F.sum("count").over(order), F.lit(0))).drop("count")
    number = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece", "ids_crc32")
    out = cell.withColumn("_at", F.row_number().over(number) - 1).join(base, ["length", "_cell"])
    return out.withColumn("rank", F.col("_base") + F.col("_at")).drop("_base", "_at", "_cell")


def pack_documents(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """PIECES and sequence_id, offset: every piece's place in sequences of at most ``capacity`` tokens.

    No token is lost or doubled; a sequence has no gap. Repeated rows are packed as often as they occur, columns
    other than key and text are not read, and an empty table gives an empty result.
    """
    pieces = stored(token_pieces(df, path, capacity, end_id, key, text).withColumn("_spread", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    table = entries(plan(histogram, capacity))
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(table)

    def place(batches):
        t = shared.value
        starts = (t[:, 0] << 44) | t[:, 1]
        for batch in batches:
            size, rank = batch.column(0).to_numpy(), batch.column(5).to_numpy()
            e = t[np.searchsorted(starts, (size << 44) | rank, "right") - 1] if len(size) else np.zeros((0, 5), np.int64)
            into = rank - e[:, 1]
            columns = [batch.column(k) for k in (1, 2, 3, 0, 4)]
            columns += [pa.array(e[:, 2] + into // np.maximum(e[:, 3], 1)), pa.array(e[:, 4] + into % np.maximum(e[:, 3], 1) * size)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(pieces, sum(histogram.values())).select("length", "doc_id", "piece", "start", "ids_crc32", "rank").mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
