import random

import pytest

from folioflow.llm import neardup
from folioflow.llm.common import load, prepare

SCHEMA = "doc_id long, text string, component_id string, n long, a string"


def brute_force(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs of full sets of words."""
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    lists, up = {}, {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for d, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(d)
    for d, s in sets.items():
        shared = {}
        for x in s:
            for o in lists[x]:
                shared[o] = shared.get(o, 0) + 1
        for o, n in shared.items():
            if o < d and 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                a, b = root(o), root(d)
                up[max(a, b)] = min(a, b)
    return sorted((d, len(s), root(d)) for d, s in sets.items())


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("seed", [1])
def test_against_brute_force(spark, seed, monkeypatch):
    """Families of near copies, a common passage in unrelated texts, and lists longer than the bound."""
    monkeypatch.setattr(neardup, "LIST_ROWS", 6)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 8)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows, doc = [], 0
    for size in (1, 2, 3, 8, 30, 60):
        base = [word() for _ in range(rng.choice((12, 60, 200)))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 20)):
                w[rng.randrange(len(w))] = word()
            rows.append((doc, " ".join(w)))
            doc += 1
    for _ in range(60):
        rows.append((doc, " ".join(passage + [word() for _ in range(rng.choice((5, 30, 100)))])))
        doc += 1
    rows += [(doc, ""), (doc + 1, None), (doc + 2, "a b"), (doc + 3, "A  B\n"), (doc + 4, rows[5][1])]
    rng.shuffle(rows)
    prepare(spark)
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(3)
    assert got(neardup.near_dedup(df)) == brute_force(rows)


def test_query_against_brute_force(spark, small):
    docs = load(spark, small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(neardup.near_dedup(docs)) == brute_force(rows)


def test_edges(spark):
    prepare(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert neardup.near_dedup(empty).collect() == []
    assert neardup.without_near_duplicates(empty).columns == empty.columns
    df = spark.createDataFrame([(1, "a b c d e f", "p", 1, "q"), (1, "a b c d e f", "p", 1, "q"), (None, "x y z u v w", "p", 1, "q"), (3, None, "p", 1, "q"), (2, "a b c d e f", "p", 1, "q")], SCHEMA)
    rows = sorted(((r.doc_id or -1), r.n_shingles, r.component_id, r.kept) for r in neardup.near_dedup(df).collect())
    assert rows == [(-1, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert sorted((r.doc_id or -1) for r in neardup.without_near_duplicates(df).collect()) == [-1, 1, 1, 3]


def test_estimate_below_the_former_margin(spark):
    """Links whose union sketch estimates far below their similarity count: they are verified on full sets."""
    rng = random.Random(5)
    prepare(spark)
    for _ in range(100_000):
        one = [f"w{rng.randrange(10**9)}" for _ in range(204)]
        two = ["x" if k in (20, 50, 80, 110, 140, 201) else w for k, w in enumerate(one)]
        a, b = " ".join(one), " ".join(two)
        x, y = neardup.shingle_set(a), neardup.shingle_set(b)
        if 0.5 <= neardup.estimate(x[: neardup.K], y[: neardup.K]) < 0.56:
            break
    assert neardup.jaccard_at_least(x, y, 75)
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in ((1, a), (2, b))], SCHEMA)
    assert got(neardup.near_dedup(df)) == brute_force([(1, a), (2, b)])


@pytest.mark.parametrize("seed", [1])
def test_families_near_the_limit(spark, seed):
    """Lists longer than the bound, in which pairs are 60 to 90 % similar: no link is lost."""
    rng = random.Random(seed)
    prepare(spark)
    rows = []
    for size, length, edits in ((150, 120, 3), (150, 300, 7), (60, 80, 2)):
        base = [f"w{rng.randrange(10**9)}" for _ in range(length)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(1, edits + 1)):
                w[rng.randrange(length)] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(4)
    assert got(neardup.near_dedup(df)) == brute_force(rows)


def test_large_list(spark):
    """A passage in 4,000 texts: those that are little else are one component, the others are apart."""
    prepare(spark)
    passage = " ".join(f"p{k}" for k in range(100))
    own = lambda d, n: " ".join(f"d{d}o{k}" for k in range(n))
    rows = [(d, f"{own(d, 6)} {passage} {own(-d, 6)}" if d < 3_000 else f"{passage} {own(d, 60)}") for d in range(4_000)]
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(4)
    assert {r.doc_id: r.component_id for r in neardup.near_dedup(df).collect()} == {d: 0 if d < 3_000 else d for d in range(4_000)}


def test_chain(spark):
    """Texts that slide over a long one: only neighbours are near copies, all are one component."""
    prepare(spark)
    words = [f"w{k}" for k in range(2_000)]
    ids = random.Random(4).sample(range(10**9), 60)
    rows = [(d, " ".join(words[20 * k : 20 * k + 200])) for k, d in enumerate(ids)]
    out = got(neardup.near_dedup(spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA)))
    assert out == brute_force(rows) and {c for _, _, c in out} == {min(ids)}


@pytest.mark.parametrize("percent", [75, 80, 100])
def test_prefixes_meet(percent):
    """Sets that are similar enough share one of their rarest shingles, whatever the order; the smaller needs fewer."""
    rng = random.Random(percent)
    for _ in range(3_000):
        n = rng.randrange(1, 60)
        a = set(range(n))
        b = set(rng.sample(sorted(a), rng.randrange((n + 1) // 2, n + 1))) | set(range(1_000, 1_000 + rng.randrange(0, 1 + n // 2)))
        if 100 * len(a & b) >= percent * len(a | b):
            order = {x: rng.random() for x in a | b}
            small, large = sorted((a, b), key=len)
            few, most = int(neardup.prefix_sizes(len(small), percent)[1]), int(neardup.prefix_sizes(len(large), percent)[0])
            assert set(sorted(small, key=order.get)[:few]) & set(sorted(large, key=order.get)[:most])


def test_rows_of_one_key(spark):
    """Different texts under one doc_id are linked; extra columns may have any name."""
    prepare(spark)
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (5, "h i j k l m n"), (7, "q r s t u v w"), (None, "q r s t u v w")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, _gone long, node long")
    assert sorted((r.doc_id or -1, r.component_id) for r in neardup.near_dedup(df).collect()) == [(-1, 7), (1, 1), (1, 1), (5, 1), (7, 7)]
    out = neardup.without_near_duplicates(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect() if r.doc_id) == [1, 1, 7]
