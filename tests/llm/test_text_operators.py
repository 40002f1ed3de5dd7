"""Encoding, packing, fingerprints, chats, archives and exact deduplication against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.llm import bpe, chat_format, exact_dedup, fingerprint, packing, warc
from folioflow.llm.common import load, prepare

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, "a", "  a  b\n\n c\t\n", "x" * 5000, "don't 12ab \x1c!\x1d z\x85 y 　w", "<|endoftext|> é漢字🙂", "a " * 70_000, "9" * 3000 + "a" * 3000, "\r\n \t" * 200]
SCHEMA = "doc_id long, text string, piece string, kept string"


def frame(spark, texts):
    prepare(spark)
    return spark.createDataFrame([(k, t, "p", "k") for k, t in enumerate(texts)], SCHEMA)


def test_bpe_is_the_library(spark, small, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    texts = [t or "" for t in ODD] + [r.text for r in load(spark, small, "documents").collect()]
    for t in texts:
        ids = bpe.encode(enc, t)
        assert ids == enc.encode_ordinary(t) and enc.decode_bytes(ids) == t.encode()
        assert "".join(bpe.safe_pieces(t)) == t
    got = {r.doc_id: r for r in bpe.digests(frame(spark, ODD), RANKS, public_tokenizers.PATTERN).collect()}
    for k, t in enumerate(ODD):
        ids = enc.encode_ordinary(t or "")
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    df = frame(spark, ODD)
    back = bpe.decode_documents(bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.raw) for r in back.collect()} == {k: (t or "").encode() for k, t in enumerate(ODD)}
    assert bpe.digests(df.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def packed_well(rows, texts, capacity=2048):
    tok, *_ = packing._tokenizer(JSON)
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    for k, t in enumerate(texts):
        raw = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        at = 0
        for n, r in enumerate(sorted(by_doc[k], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and r.ids_crc32 == zlib.crc32(raw[4 * at : 4 * (at + r.length)])
            assert r.length == capacity or n == 0
            at += r.length
        assert at * 4 == len(raw)
    for part in by_bin.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_bin)


def test_packing(spark, small):
    docs = [r.text for r in load(spark, small, "documents").collect()]
    texts = [*ODD, *docs]
    rows = packing.pack_documents(frame(spark, texts), JSON).collect()
    bins = packed_well(rows, texts)
    assert bins <= -(-sum(r.length for r in rows) // 2048) + 2
    assert packing.pack_documents(frame(spark, texts).limit(0), JSON).collect() == []


def test_rows_of_one_key_are_dealt_out(spark, monkeypatch):
    """Pieces of a null key, however many, are numbered in many cells."""
    monkeypatch.setattr(packing, "CELL_ROWS", 10)
    prepare(spark)
    df = spark.createDataFrame([(None, "same text")] * 400 + [(k, "other words") for k in range(20)], "doc_id long, text string").repartition(4)
    out = packing.pack_documents(df, JSON, capacity=8).collect()
    assert len(out) == 420 and len({(r.sequence_id, r.offset) for r in out}) == 420 and all(r.offset + r.length <= 8 for r in out)
    pieces = spark.createDataFrame([(None, 0, 0, 3, 5, k * 7_919) for k in range(400)], "doc_id long, piece int, start long, length long, ids_crc32 long, _spread long")
    got = packing.ranked(pieces, 400)
    assert sorted(r["rank"] for r in got.collect()) == list(range(400)) and "_spread" not in got.columns


def split_ids(texts):
    ids, bounds = packing._text_ids(JSON, pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_word_cache_forgets(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    tok, *_ = packing._tokenizer(JSON)
    texts = [f"w{k} same w{k + 1}" for k in range(40)]
    for k in range(0, 40, 4):
        for t, ids in zip(texts[k : k + 4], split_ids(texts[k : k + 4]), strict=True):
            assert ids == tok.encode(t, add_special_tokens=False).ids
        assert len(packing._tokenizer(JSON)[2]) <= 3 + 9  # what is over it stays only until the next batch


@pytest.mark.parametrize("block", (8 << 20, 64))
def test_words_of_any_kind(monkeypatch, block):
    """Texts cut into words, and long ones into parts first, have the ids of whole texts."""
    monkeypatch.setattr(packing, "BLOCK_BYTES", block)
    r, tok = random.Random(5), packing._tokenizer(JSON)[0]
    kinds = " \n\t\r\xa0\u3000ab1.,'!\x00\x01\\\xe9\u4e2d\U0001f600\u0120\u010a"
    texts = ["", " ", "   x", "a\x00b c.d", "\x000\x01 \x00", "<|endoftext|> hi. <|endoftext|>", "x\n\n  y  ", "it's  we'll.\n \n z", "x" * 300, *["".join(r.choices(kinds, k=r.randrange(200))) for _ in range(500)]]
    for part in (texts, [t for t in texts if "\x00" not in t], [""], []):
        assert split_ids(part) == [tok.encode(t, add_special_tokens=False).ids for t in part]
    column = pa.array(texts)
    assert [k for a, n in packing._slices(column) for k in range(a, a + n)] == list(range(len(texts)))


def test_packing_memory(monkeypatch):
    """What Arrow holds while a batch of 8 MB is encoded, and that offsets of four and eight bytes give the same."""
    r = random.Random(3)
    words = ["".join(r.choices("abcdefgh", k=r.randint(1, 8))) for _ in range(5_000)]
    texts = pa.array([" ".join(r.choices(words, k=400)) for _ in range(3_700)])
    assert 6 << 20 < texts.nbytes < 8 << 20
    usual, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    packing._text_ids(JSON, texts[:1])
    pa.set_memory_pool(pool)
    try:
        for start, n in packing._slices(texts):
            packing._text_ids(JSON, texts.slice(start, n))
        assert pool.max_memory() < 40e6
    finally:
        pa.set_memory_pool(usual)
    ids, bounds = packing._text_ids(JSON, pa.array(["a b", "", "c. d"]))
    monkeypatch.setattr(packing, "WIDE_BYTES", 0)
    wide = packing._text_ids(JSON, pa.array(["a b", "", "c. d"]))
    assert ids.tolist() == wide[0].tolist() and bounds.tolist() == wide[1].tolist()


def test_single_spaces_and_words_met_once(monkeypatch):
    """Texts with and without spaces that stand together, one after the other; of 3,000 words met once in each text none is encoded again."""
    packing._tokenizer.cache_clear()
    tok = packing._tokenizer(JSON)[0]
    for texts in ([" a b\nc. d\u3000e", "x y, z"], ["a  b \n c", " a b"], ["\x00 a b\n", "\x000\x01 c d"], ["a b", ""]):
        assert split_ids(texts) == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    text, met, encoded = " ".join(f"q{k}z" for k in range(3_000)), [], packing._encoded
    monkeypatch.setattr(packing, "_encoded", lambda path, words: met.append(len(words)) or encoded(path, words))
    assert split_ids([text]) == split_ids([text]) == [tok.encode(text, add_special_tokens=False).ids]
    assert met == [3_000, 0]


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_valid_and_small(seed):
    r = random.Random(seed)
    sizes = [min(100, max(1, int(r.lognormvariate(3, 1)))) for _ in range(r.choice((1, 20, 400, 3000)))]
    histogram = {s: sizes.count(s) for s in set(sizes)}
    plan = packing.plan(histogram, 100)
    assert all(sum(c) <= 100 for c, _ in plan)
    used = {}
    for chosen, times in plan:
        for s in chosen:
            used[s] = used.get(s, 0) + times
    assert used == histogram
    total = lambda p: sum(n for _, n in p)
    assert total(plan) <= total(packing.best_fit(histogram, 100))


def test_plan_finds_the_optimum():
    """Best fit needs three bins here, bin completion two."""
    assert sum(n for _, n in packing.plan({6: 1, 5: 1, 4: 1, 3: 1, 2: 1}, 10)) == 2
    assert sum(n for _, n in packing.plan({4: 2, 3: 2, 2: 3}, 10)) == 2


def brute_prints(text):
    """Chunks by the definition, byte by byte."""
    data, gear = text.encode(), [int(x) for x in fingerprint.GEAR]
    met = lambda i, bits: ((sum(gear[data[i - k]] << k for k in range(min(fingerprint.WINDOW, i + 1))) & 0xFFFFFFFF) >> (32 - fingerprint.WINDOW)) % (1 << bits) == 0
    out, at = [], 0
    while at < len(data):
        end = next((e for e in range(at + fingerprint.LEAST, at + fingerprint.WANTED + 1) if e <= len(data) and met(e - 1, fingerprint.STRICT)), None)
        end = end or next((e for e in range(at + fingerprint.WANTED + 1, at + fingerprint.MOST + 1) if e <= len(data) and met(e - 1, fingerprint.LOOSE)), None)
        at = end or min(at + fingerprint.MOST, len(data))
        out.append(at)
    return out


def test_fingerprints(spark, small, monkeypatch):
    docs = load(spark, small, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for t in list(texts.values())[:15]:
        assert fingerprint.cuts(t[:1500].encode()) == brute_prints(t[:1500])
    monkeypatch.setattr(fingerprint, "BLOCK", 700)
    long = max(texts.values(), key=len)
    first = fingerprint.cuts(long.encode())
    monkeypatch.setattr(fingerprint, "BLOCK", 1 << 20)
    assert first == fingerprint.cuts(long.encode())
    order = sorted(texts, reverse=True)
    want = {}
    for k, d in enumerate(order):
        follow = texts[order[(k + 1) % len(order)]]
        e = fingerprint.edited(texts[d], follow)
        p = [fingerprint.fingerprint(x) for x in (texts[d], e, follow)]
        want[d] = (len(texts[d]), hashlib.sha256(e.encode()).hexdigest(), fingerprint.named(p[0]), fingerprint.named(p[1]), fingerprint.containment(p[0], p[1]), fingerprint.containment(p[0], p[2]))
    got = {r.doc_id: tuple(r)[1:] for r in fingerprint.compare_edited(docs, rows_a_bucket=30).collect()}
    assert got == want
    assert np.mean([w[4] for w in want.values()]) > 0.5 > np.mean([w[5] for w in want.values()])


def test_fingerprint_edges(spark):
    got = {r.doc_id: r for r in fingerprint.compare_edited(frame(spark, ODD)).collect()}
    assert len(got) == len(ODD) and got[0].near_edited == 1.0 and got[0].fingerprint == got[1].fingerprint
    single = fingerprint.compare_edited(frame(spark, ["abcdef"])).collect()
    assert [r.edited_sha256 for r in single] == [hashlib.sha256(b"abcdab").hexdigest()]
    assert fingerprint.compare_edited(frame(spark, ODD).limit(0)).collect() == []
    shown = fingerprint.fingerprints(frame(spark, ODD)).collect()
    assert shown[0].fingerprint == shown[1].fingerprint and shown[0].chunks == []


@pytest.mark.parametrize("text", [t or "" for t in ODD] + ["\\### Assistant: </turn> ok", "</turn>\n### x: y", "\\", "###", "\\\\###</turn"])
def test_chat_escape(text):
    turns = [(0, text, text), (1, "assistant", text)]
    shown, spans = chat_format.render(turns)
    assert chat_format.parse(shown) == [(text, text), ("assistant", text)]
    assert chat_format.unescape(shown[spans[-1][0] : spans[-1][1]]) == text


def test_chat_fold(spark):
    prepare(spark)
    events = [(1, 0, 0, "start", "user", "hi"), (1, 1, 1, "start", "assistant", None), (1, 2, 1, "delta", None, "he"), (1, 3, 1, "delta", None, "llo"), (1, 4, 1, "regenerate", None, None), (1, 5, 1, "delta", None, "bye"), (1, 6, 0, "edit", "user", "hey"), (1, 7, 2, "start", "user", "x"), (1, 8, 2, "delete", None, None)]
    events += [(2, k, k, "start", "assistant", f"t{k}") for k in range(600)]
    df = spark.createDataFrame(events, "conv_id long, seq long, turn long, kind string, role string, text string").orderBy(F.rand(1))
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_sha256) == (2, sha("user\nhey\nassistant\nbye\n"), sha("bye"))
    assert (got[2].n_turns, got[2].loss_sha256) == (600, sha("".join(f"t{k}" for k in range(600))))
    assert chat_format.read_back(chat_format.format_chats(df.limit(0))).collect() == []


def test_chat_repeated_turns(spark):
    """Rows that repeat a turn number stay turns of their own, as the query's SQL has them."""
    import duckdb

    from folioflow.llm.queries import oracle_sql

    prepare(spark)
    rows = [(1, 0, "user", "hi"), (1, 0, "assistant", "yes"), (1, 1, "assistant", "a" * 5_000), (1, 1, "assistant", "b" * 4_500), (1, 1, "assistant", "b" * 4_500), (2, 3, "user", ""), (2, 3, None, None), (3, 0, "user", "x")]
    rows += [(4, t, "assistant", f"turn {t}") for t in (None, -1, 0, 1_700_000_000_123, 1_700_000_000_124, -(1 << 62), (1 << 62) + 5)] + [(4, None, "user", "also null")]
    rows += [(-7, k, r, "\\### Assistant: </turn> ok") for k, r in enumerate(("user", "assistant"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conversations = df.filter("conv_id <> -7").toPandas()  # noqa: F841
    out = chat_format.read_back(chat_format.format_chats(chat_format.events_of_turns(df)))
    assert sorted(map(tuple, out.collect())) == sorted(duckdb.sql(oracle_sql()["op3_chat_format"]).fetchall())


def test_warc_records_and_edges(spark):
    prepare(spark)
    big = "é" * 600
    rows = [(1, "http://a", big), (2, None, big), (3, "http://c\n", "x"), (4, "http://d", "x"), (5, "u", None), (None, "n", big), (2, None, big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(warc.archive_pages(pages)).collect()), key=str)
    assert got == sorted([(1, 1200, "revisit", 2), (2, 1200, "response", None), (2, 1200, "response", None), (3, 1, "response", None), (4, 1, "response", None), (5, 0, "response", None), (-1, 1200, "revisit", 2)], key=str)
    index = warc.archive_pages(pages).filter("url = 'http://d'")
    assert [r.page_id for r in warc.read_archives(index).collect()] == [4]
    assert warc.read_archives(warc.archive_pages(pages.limit(0))).collect() == []


@pytest.mark.parametrize("bits", [18, 27])
def test_exact_dedup(spark, small, bits):
    rows = [(r.doc_id, r.text) for r in load(spark, small, "documents").collect()]
    rows += [(10_000 + k, "same") for k in range(700)] + [(20_000, ""), (20_001, None), (20_002, None)]
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    df = spark.createDataFrame([(d, t, "p", "k") for d, t in rows], SCHEMA)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256, r.piece) for r in exact_dedup.exact_dedup(df, max_bits=bits).collect()}
    assert got == {d: (max(groups[t or ""]), len(groups[t or ""]), d == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest(), "p") for d, t in rows}
    assert exact_dedup.exact_dedup(df.limit(0)).collect() == []


def test_full_filter_is_still_exact(spark, small, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_BITS", 15)
    docs = load(spark, small, "documents")
    got = exact_dedup.exact_dedup(docs.select("doc_id", "text"), max_bits=15)
    assert got.filter("kept").count() == docs.select("text").distinct().count()


def test_plan_tries():
    """The search over plans has its twelve variants."""
    assert packing.PLAN_TRIES >= 12


def fewest(sizes, capacity):
    """The least number of bins, by trying every place of every piece."""
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= sizes[k] and bins[i] not in bins[:i]:
                place(k + 1, [*bins[:i], bins[i] - sizes[k], *bins[i + 1 :]])
        place(k + 1, [*bins, capacity - sizes[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_exact_plans_are_optimal(seed):
    r = random.Random(seed)
    capacity = r.choice((10, 20, 60))
    sizes = sorted((r.randrange(1, capacity + 1) if seed % 2 else r.randrange(capacity // 4, capacity // 2 + 2) for _ in range(r.randrange(1, 11))), reverse=True)
    plan = packing.plan({s: sizes.count(s) for s in sizes}, capacity, tries=0, exact=True)
    assert sorted((s for c, n in plan for _ in range(n) for s in c), reverse=True) == sizes and all(sum(c) <= capacity for c, _ in plan)
    assert sum(n for _, n in plan) == fewest(sizes, capacity)


def test_domination():
    assert packing.dominates((5,), (3, 2)) and packing.dominates((4, 3), (2, 2, 3)) and packing.dominates((4,), ())
    assert not packing.dominates((3, 3), (4, 1)) and not packing.dominates((5,), (3, 3)) and not packing.dominates((), (1,))
    assert packing.undominated([0, 1, 1, 1, 0, 0], 4) == [(3, 1)]


def test_long_turns():
    """A turn of 20 million characters with control strings: time and memory stay in proportion."""
    import resource
    import time

    text = "word </turn> \\ ### and : so on\n" * 600_000
    shown, _ = chat_format.render([(0, "user", text)])
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.monotonic()
    assert chat_format.parse(shown) == [("user", text)]
    assert time.monotonic() - began < 30 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000


@pytest.mark.parametrize("broken", ["x", "### a", "### a: b", "### a: b</turn>", "### a: b</turn>x", "### a: b\\</turn>\n", "### a:b</turn>\n", "### a: b</turn>\n### "])
def test_broken_chats_are_errors(broken):
    with pytest.raises(ValueError, match="no turn"):
        chat_format.parse(broken)


def test_long_texts_become_events(spark):
    text = "ab🙂\n" * 3_000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "user", None), (1, 2, "assistant", "x" * 4_000)], "conv_id long, turn long, role string, text string")
    rows = chat_format.events_of_turns(df).orderBy("turn", "seq").collect()
    assert "".join(r.text for r in rows if r.turn == 0) == text and [len(r.text) for r in rows] == [2_000] * 6 + [0, 2_000, 2_000]


def test_range_reads_are_single_reads(spark):
    """Coalesced reads of some records give what reading each by itself gives, and the index says where they are."""
    import zlib as z

    from pyarrow import fs

    prepare(spark)
    pages = spark.createDataFrame([(k, f"http://{k}", "p" * (k % 7 * 400)) for k in range(200)], "page_id long, url string, html string")
    index = warc.archive_pages(pages.repartition(3))
    rows = index.collect()
    for r in rows[::20]:
        store, path = fs.FileSystem.from_uri(r.file)
        with store.open_input_file(path) as f:
            raw = z.decompress(f.read_at(r.length, r.offset), 31)
        page, size, digest, kind, _ = warc.parse(raw)
        assert (page, digest, kind, f"WARC-Target-URI: {r.url}".encode() in raw) == (r.page_id, r.digest, r.record_type, True) and size == r.page_id % 7 * 400
    some = index.filter("page_id % 3 = 0")
    for gap, span in ((0, 1), (1 << 16, 8 << 20)):
        assert sorted(r.page_id for r in warc.read_archives(some, gap, span).collect()) == list(range(0, 200, 3))


def test_fingerprints_of_one_key(spark):
    """Rows of one key, or without any, are spread over buckets and keep one order."""
    texts = [f"text number {k} " * 9 for k in range(300)]
    rows = [(None if k % 3 else 7, t) for k, t in enumerate(texts)] + [(k, f"other {k}") for k in range(100, 140)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprint.compare_edited(df, rows_a_bucket=10).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((d or -1, len(t)) for d, t in rows)
    follow = {}
    for d, t in rows:
        for _, u in rows:
            follow[d, hashlib.sha256(fingerprint.edited(t, u).encode()).hexdigest()] = 1
    assert all((r.doc_id, r.edited_sha256) in follow for r in got)


def test_columns_of_any_name(spark):
    """Extra columns that are called as an operator's own ones."""
    prepare(spark)
    df = spark.createDataFrame([(1, "a", 5, 6, 7, 8), (2, "a", 5, 6, 7, 8), (3, "b", 5, 6, 7, 8)], "doc_id long, text string, _maybe long, _s0 long, _hk long, _text long")
    out = exact_dedup.exact_dedup(df)
    assert out.columns[:6] == df.columns and sorted((r.doc_id, r.kept, r._maybe, r._s0, r._hk) for r in out.collect()) == [(1, False, 5, 6, 7), (2, True, 5, 6, 7), (3, True, 5, 6, 7)]
    dotted = exact_dedup.exact_dedup(df.withColumnsRenamed({"_hk": "x.y", "_text": "`q`"}))
    assert dotted.columns[4:6] == ["x.y", "`q`"] and {r["x.y"] for r in dotted.collect()} == {7}
    shown = fingerprint.fingerprints(df)
    assert shown.columns == [*df.columns, "fingerprint", "chunks"] and {r._text for r in shown.collect()} == {8}
