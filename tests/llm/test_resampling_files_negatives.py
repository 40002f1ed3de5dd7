"""Importance resampling, token files and hard negatives against plain versions."""

import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from folioflow.llm import hard_negatives, importance, token_files
from folioflow.llm.common import load, prepare, stored

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "a", "  A  b\n\n c\t\n", "x" * 5000, "don't 12ab \x1c!\x1d z\x85 y 　w İΣς é é ́ I've'LL", "<|endoftext|> é漢字🙂", "a b " * 20_000, "9" * 300 + "a" * 300, "\r\n \t\x0b\x0c" * 20, "same text twice", "same text twice", "a\x00b \x00 c \x00\x00 d"]
CLASHES = "doc_id long, text string, weight string, `x.y` string, stream string, ids string"


def frame(spark, texts):
    prepare(spark)
    return spark.createDataFrame([(k, t, "p", "q", "s", "i") for k, t in enumerate(texts)], CLASHES)


# --- resampling ---------------------------------------------------------------------------------------------------


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_features(text, most=2):
    w = plain_words(text)
    return [" ".join(w[k : k + n]) for n in range(1, most + 1) for k in range(len(w) - n + 1)]


def plain_resample(docs, target, share=25, least=20, most=2, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in plain_features(text, most):
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    rows = []
    for key, text in docs:
        f = plain_features(text, most)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(plain_words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(fit[: share * len(fit) // 100], 1):
        r[5] = k
    return sorted(map(tuple, rows), key=repr)


def resampled(df, target, **how):
    return sorted(map(tuple, importance.resample(df, target, **how).collect()), key=repr)


def test_resampling_is_the_plain_version(spark, small, monkeypatch):
    monkeypatch.setattr(importance, "STREAM_FEATURES", 3_000)
    docs = [(r.doc_id, r.text) for r in load(spark, small, "documents").collect()]
    target = [r.text for r in load(spark, small, "benchmark").collect()]
    got = resampled(load(spark, small, "documents"), load(spark, small, "benchmark"))
    assert got == plain_resample(docs, target)
    assert sum(r[5] is not None for r in got) == 25 * sum(r[1] >= 20 for r in got) // 100 > 0


def test_resampling_edges(spark, monkeypatch):
    monkeypatch.setattr(importance, "COPIES", 2)
    docs = [(k, t) for k, t in enumerate(ODD)] + [(3, "red " * 30)] * 7 + [(None, "blue " * 25)] * 5 + [(None, "red " * 30)] * 3
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    target = ["red red red", None, ""]
    for share in (25, 50, 100, 0):
        assert resampled(df, spark.createDataFrame([(t,) for t in target], "text string"), share=share, least_words=1) == plain_resample(docs, target, share, 1)
    none = spark.createDataFrame([], "text string")
    assert resampled(df, none, most=3, buckets=100) == plain_resample(docs, [], most=3, buckets=100)
    assert resampled(df.limit(0), none) == []
    ranks = importance.resample(frame(spark, ODD), none, least_words=1, share=40)
    kept = importance.drawn(frame(spark, ODD), ranks)
    assert kept.columns == frame(spark, ODD).columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in ranks.collect() if r.rank}


@pytest.mark.parametrize("most", [1, 2, 3])
def test_features_do_not_depend_on_blocks(most):
    for text in ODD:
        raw = (text or "").encode()
        whole, n = importance.features(raw, most)
        for size in (1, 7, 64):
            parts, m = importance.features(raw[:3000], most, size=size)
            want, k = importance.features(raw[:3000], most)
            assert m == k and sorted(parts) == sorted(want)
        assert n == len(plain_words(text)) and sorted(whole) == sorted(zlib.crc32(f.encode()) % 10_000 for f in plain_features(text, most))


def test_runs_merge_to_counts(spark, monkeypatch):
    monkeypatch.setattr(importance, "RUNS", 2)
    monkeypatch.setattr(importance, "STREAM_FEATURES", 50)
    texts = [" ".join(f"w{k % 7}" for k in range(n)) for n in range(40)]
    counts = importance.bucket_counts(importance.bucket_streams(frame(spark, texts), buckets=64), 64)
    want = np.bincount([zlib.crc32(f.encode()) % 64 for t in texts for f in plain_features(t)], minlength=64)
    assert counts.tolist() == want.tolist()
    with pytest.raises(ValueError, match="two bytes"):
        importance.bucket_streams(frame(spark, texts), buckets=1 << 17)


# --- token files --------------------------------------------------------------------------------------------------


def plain_ids(texts, end=2):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    return [[*tok.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def plain_records(keys, ids):
    at, out = 0, []
    crc = [zlib.crc32(np.array(x, "<u4")) for x in ids]
    for k in sorted(range(len(keys)), key=lambda k: (keys[k] is not None, keys[k] or 0, len(ids[k]), crc[k])):
        out.append((keys[k], at, len(ids[k]), crc[k]))
        at += len(ids[k])
    return out


def test_ids_are_the_library(spark, small, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 2_000)
    texts = [t or "" for t in ODD] + [r.text for r in load(spark, small, "documents").collect()]
    for part in (texts, texts[:4], texts[4:5]):
        ids, bounds = token_files.text_ids(WORDS, pa.array(part, pa.string()), np.dtype("<u2"))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [x[:-1] for x in plain_ids(part)]


@pytest.mark.parametrize("length", [16, 2048])
def test_token_files_are_read_back(spark, small, monkeypatch, length):
    monkeypatch.setattr(token_files, "LEAST_BYTES", 20_000)
    monkeypatch.setattr(token_files, "BATCH_SEQUENCES", 4)
    docs = load(spark, small, "documents").select("doc_id", "text").repartition(3)
    rows = docs.collect()
    index = token_files.write_documents(docs, WORDS, length=length)
    want = plain_records([r.doc_id for r in rows], plain_ids([r.text for r in rows]))
    assert sorted(map(tuple, token_files.read_files(index).collect()), key=lambda r: r[1]) == want
    shards = {r.shard: r.file for r in index.select("shard", "file").distinct().collect()}
    assert len(shards) > 1
    stream = []
    for _, name in sorted(shards.items()):
        file = token_files.Sequences(name)
        for k in range(len(file)):
            ids, mask = file.ids(k), file.mask(k).to_numpy(zero_copy_only=False)
            assert len(ids) == len(mask) == length and (mask.all() or k == len(file) - 1)
            assert not ids[~mask].any()
            stream += ids[mask].tolist()
        file.close()
    by_key = dict(zip([r.doc_id for r in rows], plain_ids([r.text for r in rows]), strict=True))
    assert stream == [i for k in sorted(by_key) for i in by_key[k]]


def test_sequences_are_views_of_the_file(tmp_path):
    uri = f"file://{tmp_path}/one.arrow"
    out = token_files.ShardWriter(uri, np.dtype("<u2"), 8, 4)
    out.add(np.arange(70, dtype="<u2"))
    out.close()
    file = token_files.Sequences(uri)
    assert len(file) == 9 and file.ids(3).tolist() == list(range(24, 32)) and file.mask(8).to_pylist() == [True] * 6 + [False] * 2
    one, again = file.ids(5), file.ids(5)
    assert not one.flags.owndata and one.ctypes.data == again.ctypes.data  # the same memory, not a copy
    assert [v.tolist() for v in file.tokens(30, 5)] == [[30, 31], [32, 33, 34]]
    for at, n in ((68, 3), (71, 1)):
        with pytest.raises(ValueError, match="ends before"):
            list(file.tokens(at, n))


def test_token_files_edges(spark, monkeypatch):
    monkeypatch.setattr(token_files, "LEAST_BYTES", 1)
    docs = [(k, t) for k, t in enumerate(ODD)] + [(None, "b b"), (None, "a"), (None, None)] + [(4, "hot row")] * 60
    df = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in docs], "doc_id long, text string, at int, `a.b` int, shard int").repartition(4)
    index = stored(token_files.write_documents(df, WORDS, length=32), "again")
    rows = sorted(map(tuple, token_files.read_files(index).collect()), key=lambda r: r[1])
    ends = [r[1] + r[2] for r in rows]
    assert [r[1] for r in rows] == [0, *ends[:-1]]  # nothing between documents
    assert [r[0] for r in rows] == sorted((k for k, _ in docs), key=lambda k: (k is not None, k or 0))
    want = plain_records([k for k, _ in docs], plain_ids([t for _, t in docs]))
    assert sorted(((k, n, c) for k, _, n, c in rows), key=repr) == sorted(((k, n, c) for k, _, n, c in want), key=repr)
    assert index.filter("doc_id = 4").select("shard").distinct().count() > 1  # rows of one key are dealt out
    empty = token_files.write_documents(df.limit(0), WORDS)
    assert empty.collect() == [] and token_files.read_files(empty).collect() == []


# --- hard negatives -----------------------------------------------------------------------------------------------


def plain_negatives(rows, anchor, positives=5, negatives=5, low=80, high=100):
    fine = [(k, lab, [math.floor(256 * x) for x in v]) for k, v, lab in rows if k is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for k, lab, v in fine:
        if not anchor(k):
            continue
        near = sorted((-dot(v, w), i) for i, other, w in fine if other == lab and i != k)[:positives]
        far = sorted((-dot(v, w), i) for i, other, w in fine if other != lab)
        for s, i in near:
            found = [(t, j) for t, j in far if low * -s <= high * -t <= high * -s][:negatives]
            out += [(k, i, n, j, -s, -t) for n, (t, j) in enumerate(found, 1)]
    return sorted(out)


def mined(df, anchors=lambda k: k % 100 == 0, **how):
    return sorted(map(tuple, hard_negatives.mine(df, anchors, **how).collect()))


def test_negatives_are_the_plain_version(spark, small, monkeypatch):
    df = load(spark, small, "embeddings")
    want = plain_negatives([(r.vec_id, r.embedding, r.label) for r in df.collect()], lambda k: k % 20 == 0)
    assert len(want) > 100
    for block, ahead, wave in ((2048, 256, 16_384), (64, 7, 10)):
        for name, value in (("BLOCK_ROWS", block), ("ANCHOR_ROWS", ahead), ("WAVE_ROWS", wave)):
            monkeypatch.setattr(hard_negatives, name, value)
        assert mined(df.repartition(3), lambda k: k % 20 == 0) == want


def here(table, anchors, low, cap, k, same):
    """``best_rows`` in the driver, where patched constants hold."""
    slots = hard_negatives.Slots(anchors, low, cap, k, same)
    for r in table.collect():
        slots.add(hard_negatives.Block.of(bytes(r.ids), bytes(r.labels), bytes(r.ints), bytes(r.turned), anchors.ints.shape[1]))
    found = slots.found().to_pandas()
    found["rank"] = found.groupby(["anchor", "slot"]).cumcount() + 1
    return table.sparkSession.createDataFrame(found, f"{hard_negatives.FOUND}, rank int")


@pytest.mark.parametrize("dense", [0.0, 1.1])
def test_ties_and_copies(spark, monkeypatch, dense):
    monkeypatch.setattr(hard_negatives, "DENSE", dense)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(5)
    kinds = rng.integers(-2, 3, (6, 8)) / 4
    rows = [(int(k), kinds[rng.integers(0, 6) if k % 3 else 0].tolist(), int(rng.integers(0, 3))) for k in rng.permutation(300) - 20]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    monkeypatch.setattr(hard_negatives, "best_rows", here)
    assert mined(df, lambda k: k % 10 == 0) == plain_negatives(rows, lambda k: k % 10 == 0)
    assert mined(df, lambda k: k % 10 == 0, positives=2, negatives=3, low=50) == plain_negatives(rows, lambda k: k % 10 == 0, 2, 3, 50)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, [], 1), (200, [1.0], 2), (1, [1.0, 0.4], 1), (2, [0.9, 0.4], 2), (3, [1.0, nan], 2), (4, [inf, 0.0], 2), (5, None, 2), (6, [1.0, None], 2), (7, [1.0, 0.5], None), (None, [1.0, 0.5], 2), (8, [0.99, 0.4, 0.1], 2), (-100, [-1.0, 0.0], 2)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, id string, `a.b` string")
    assert mined(df) == plain_negatives(rows, lambda k: k % 100 == 0)
    assert mined(df.limit(0)) == [] and mined(df, lambda k: k == 12345) == []


def test_bounds_never_discard(monkeypatch):
    """On random blocks the pairs that the bounds leave hold all pairs that are good enough, and they leave out most."""
    rng = np.random.default_rng(9)
    shape = np.geomspace(1, 0.05, 64)
    ints = np.floor(256 * rng.normal(size=(3000, 64)) * shape).astype(np.int32)
    turn = hard_negatives.rotation(ints[:500].astype(float))
    assert np.abs(turn.T @ turn - np.eye(64)).max() < 1e-9
    make = lambda part, first: hard_negatives.Block.of((np.arange(len(part)) + first).tobytes(), np.zeros(len(part), np.int64).tobytes(), part.tobytes(), (part @ turn).astype(np.float32).tobytes(), 64)
    anchors, block = make(ints[:100], 0), make(ints[100:], 100)
    exact = ints[:100].astype(np.int64) @ ints[100:].T.astype(np.int64)
    low = np.sort(exact, 1)[:, -6:-5]
    slots = hard_negatives.Slots(anchors, low, np.full_like(low, 1 << 60), 5, True)
    a, r = slots._survivors(slice(0, 100), block)
    left = set(zip(a.tolist(), r.tolist(), strict=True))
    assert {(i, j) for i, j in zip(*np.nonzero(exact >= low), strict=True)} <= left and len(left) < 0.5 * exact.size
