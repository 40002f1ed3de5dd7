"""Held-out accuracy of the two classifiers, and the pipeline against its stages done plainly."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioflow.llm import quality, toxicity
from folioflow.llm.common import load, prepare

from .test_neardup import brute_force

SCHEMA = "doc_id long, text string, score string, held_out long"
DATA = "/root/testdata/sf0.01"


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 5 == 0


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.9), (toxicity, "toxic", 0.85)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = load(spark, DATA, "documents"), load(spark, DATA, "labels")
    model = module.train(docs, labels)
    rows = module.scored(docs, model).join(labels, "doc_id").collect()
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r[label] for r in test]) >= least


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, module):
    prepare(spark)
    texts = [None, "", "word", "word", "x" * 50_000, "a " * 60_000, "idiot scum you fine person " * 10]
    df = spark.createDataFrame([(k if k != 3 else None, t, "s", 1, 9) for k, t in enumerate(texts)], SCHEMA + ", _text long")
    name = "toxic" if module is toxicity else "quality"
    labels = spark.createDataFrame([(6, 1), (6, 0), (4, 0), (None, 1), (2, None)], f"doc_id long, {name} int")
    for some in (labels, labels.limit(0)):
        net = module.train(df, some, name)
        rows = module.scored(df, net).collect()
        assert {r._text for r in rows} == {9}
        assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.held_out == held(r.doc_id) for r in rows)
    assert module.scored(df.limit(0), net).collect() == []


def test_window_cover():
    for n in (0, 1, 31, 32, 33, 56, 57, 1000):
        s = toxicity.windows(n)
        assert s[0] == 0 and (n <= 32 or s[-1] == n - 32) and (np.diff(s) <= toxicity.STRIDE).all()


def test_gradients():
    """The network's gradients against finite differences."""
    net = toxicity.Network({}, 3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    table = np.concatenate([net.padding(), r.normal(size=(5, 6 * toxicity.HIDDEN))])
    ids = np.array([[1, 2, 3, 0], [4, 5, 1, 2]])
    y, w = np.array([1.0, 0.0]), np.ones(2)
    _, g, dtable = net.gradients(table, ids, y, w)
    loss = lambda: net.gradients(table, ids, y, w)[0]
    for array, grad, at in ((net.p["att"], g["att"], (3,)), (net.p["out"], g["out"], (9,)), (net.p["rec"], g["rec"], (1, 2, 5)), (table, dtable, (2, 7)), (table, dtable, (5, 40))):
        old = array[at]
        array[at] = old + 1e-3
        up = loss()
        array[at] = old - 1e-3
        down = loss()
        array[at] = old
        assert grad[at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


def test_pipeline_stages(spark):
    docs = load(spark, DATA, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, DATA).cache()
        rows = out.collect()
        after = {r.doc_id for r in rows}
        if name != "packing":
            assert out.columns == docs.columns and len(after) == len(rows)
        if name == "exact_dedup":
            assert after == set({t: d for d, t in sorted(before.items())}.values())
        elif name == "near_dedup":
            assert after == {c for _, _, c in brute_force(before.items())}
        elif name == "packing":
            assert after == set(before)
        else:
            assert after <= set(before) and len(after) > 0.5 * len(before)
        docs = out


def test_calibration_keeps_the_share_of_labels(spark):
    """A bounded sample that takes more of the toxic labels gives the scores of all labels."""
    r = np.random.default_rng(3)
    label = (r.random(4_000) < 0.1).astype(int)
    word = lambda toxic: "bad" if r.random() < (0.5 if toxic else 0.1) else "fine"
    rows = [(k, f"some {word(t)} words {r.integers(50)}") for k, t in enumerate(label)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(t)) for k, t in enumerate(label)], "doc_id long, toxic int")
    scores = [toxicity.Scorer(toxicity.train(df, labels, max_rows=n)).scores([t for _, t in rows]).mean() for n in (100_000, 200)]
    assert scores == pytest.approx([0.1, 0.1], abs=0.04)


def test_top_word_of_the_whole_text():
    """The most frequent word counts wherever it stands."""
    words = [f"w{k}" for k in range(640)]
    words[1::10] = ["spam"] * 64
    assert quality.measure(" ".join(words))[quality.FEATURES.index("top_word")] == 0.1


def test_training_bounds_hold_on_repeated_keys(spark, monkeypatch):
    """Rows that repeat a key count each: no more than the bound of rows and characters is taken."""
    prepare(spark)
    df = spark.createDataFrame([(2, f"bad {k % 5}") for k in range(50)] + [(3, "fine " * 40)] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1, 1), (3, 0, 0)], "doc_id long, toxic int, quality int")
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, **_: seen.update(toxic=(texts, list(y))))
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.update(quality=list(y)))
    toxicity.train(df, labels, max_rows=4)
    assert sum(seen["toxic"][1]) <= 4 and len(seen["toxic"][1]) - sum(seen["toxic"][1]) <= 8 and sum(seen["toxic"][1]) > 0
    toxicity.train(df, labels, max_rows=4, max_chars=600)
    assert sum(map(len, seen["toxic"][0])) <= 600
    quality.train(df, labels, max_rows=7)
    assert len(seen["quality"]) == 7


@pytest.mark.parametrize("odd", ["long toxic text", "clean key with many rows", "toxic key with many rows", "all toxic texts are long"])
def test_no_row_empties_a_label(spark, monkeypatch, odd):
    """One long text, or one key with many rows, leaves both labels in the sample and the scores apart."""
    prepare(spark)
    learn = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5]
    order = [r.k for r in spark.createDataFrame([(k,) for k in learn], "k long").orderBy(F.xxhash64("k")).collect()]
    toxic, clean = order[0::4], [k for k in order if k not in set(order[0::4])]
    texts = {k: f"you {'awful fool' if k in set(toxic) else 'kind friend'} number {k % 9}" for k in order}
    rows = list(texts.items())
    if odd == "long toxic text":
        rows[0] = (toxic[0], "awful fool " * 2_000)
    elif odd == "all toxic texts are long":
        rows = [(k, t + " awful fool" * 600 if k in set(toxic) else t) for k, t in rows]
    else:
        many = clean[0] if odd.startswith("clean") else toxic[0]
        rows += [(many, f"{texts[many]} again {n}") for n in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k in set(toxic)), int(k not in set(toxic))) for k in order], "doc_id long, toxic int, quality int")
    for bounds in ({"max_rows": 40, "max_chars": 9_000}, {"max_rows": 40, "max_chars": 40_000}):
        net = toxicity.train(df, labels, **bounds)
        low, high = toxicity.Scorer(net).scores(["you kind friend number 3", "you awful fool number 3"])
        assert low < 0.5 < high or odd.startswith("all") and high > 3 * low  # of those only one or two fit
    model = {}
    monkeypatch.setattr(quality, "fit", lambda x, y: model.update(y=list(y)))
    quality.train(df, labels, max_rows=100)
    assert len(model["y"]) == 100 and 10 < sum(model["y"]) < 95


def plain_network(net, text):
    """The score by the definition: one window, one step, one number at a time."""
    words, h = text.encode().lower().split(), toxicity.HIDDEN
    p = {k: v.astype(float) for k, v in net.p.items()}
    sig = lambda x: 1 / (1 + np.exp(-x))
    inputs = []
    for w in words:
        grams = [g for g in toxicity.gram_buckets([w])[0]]
        mean = sum(p["gram"][g] for g in grams) / np.sqrt(max(1, len(grams))) if grams else np.zeros(toxicity.WIDTH)
        inputs.append(np.concatenate([p["word"][net.known(w)], mean]) @ p["in"] + p["bias"])
    best = -np.inf
    starts = [0] if len(words) <= 32 else sorted({*range(0, len(words) - 31, toxicity.STRIDE), len(words) - 32})
    for s in starts:
        part, states = inputs[s : s + 32], [[], []]
        for d in range(2):
            state = np.zeros(h)
            for x in part if d == 0 else part[::-1]:
                x, u = x[3 * h * d : 3 * h * (d + 1)], state @ p["rec"][d]
                z, r = sig(x[:h] + u[:h]), sig(x[h : 2 * h] + u[h : 2 * h])
                state = z * state + (1 - z) * np.tanh(x[2 * h :] + r * u[2 * h :])
                states[d].append(state)
        both = [np.concatenate(x) for x in zip(states[0], states[1][::-1], strict=True)]
        a = np.exp([x @ p["att"] for x in both])
        best = max(best, float((a / a.sum()) @ [x @ p["out"] for x in both] + p["b"][0]))
    return sig(net.slope * np.clip(best, -60, 60) + net.shift)


def test_scores_by_the_definition(spark):
    docs, labels = load(spark, DATA, "documents"), load(spark, DATA, "labels")
    texts = [t for t in (r.text for r in docs.limit(60).collect()) if t and t.strip()][:25]
    net = toxicity.train(docs, labels)
    assert toxicity.Scorer(net).scores(texts) == pytest.approx([plain_network(net, t) for t in texts], abs=2e-3)
    model = quality.train(docs, labels)
    x = np.array([quality.measure(t) for t in texts])
    bins = lambda cuts, v: sum(c <= v for c in cuts)
    for row, got in zip(x, model.score(x), strict=True):
        total = model.base + sum(float(t[bins(c, v)]) for t, c, v in zip(model.tables, model.cuts, row, strict=True))
        total += sum(float(t[bins(model.coarse[i], row[i]), bins(model.coarse[j], row[j])]) for (i, j), t in model.pairs.items())
        assert got == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_the_recurrent_part_adds_to_the_words():
    """Labels that hang on the order of two words alone, which no weights of single words can tell."""
    r = np.random.default_rng(0)
    fill = [f"f{k}" for k in range(30)]

    def text(toxic):
        w = [fill[k] for k in r.integers(0, 30, 14)]
        at = int(r.integers(0, 13))
        w[at : at + 2] = ("you", "fool") if toxic else ("fool", "you")
        return " ".join(w)

    y = (r.random(1_500) < 0.5).astype(int)
    x = [text(t) for t in y]
    right = lambda net: np.mean((toxicity.Scorer(net).scores(x[1_200:]) >= 0.5) == y[1_200:])
    assert right(toxicity.fit(x[:1_200], y[:1_200], epochs=0)) < 0.65
    assert right(toxicity.fit(x[:1_200], y[:1_200], epochs=12)) > 0.9


def test_stage_edges(spark):
    """Nulls, empty texts, repeated rows, an empty table and columns of any name in every stage of the pipeline."""
    prepare(spark)
    docs = load(spark, DATA, "documents")
    odd = spark.createDataFrame([(None, None), (None, ""), (-1, None), (-1, None), (-2, " "), (-3, "same text of five words or more"), (-4, "same text of five words or more")], "doc_id long, text string")
    more = docs.limit(60).unionByName(odd, allowMissingColumns=True)
    for extra in ("_gone", "_maybe", "score", "component_id", "x.y", "`q`"):
        more = more.withColumn(extra, F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        out, none = stage(spark, more, DATA), stage(spark, more.limit(0), DATA)
        assert none.count() == 0
        rows = out.collect()
        if name == "packing":
            assert sorted(r.doc_id or 0 for r in rows if r.piece == 0) == sorted(r.doc_id or 0 for r in more.collect())
        else:
            assert out.columns == more.columns == none.columns
            left = [r.text for r in rows]
            assert left.count("same text of five words or more") <= (1 if "dedup" in name else 2)
