"""The stored index: equal to scoring from the texts, skipping ranges, merging, and growing by batches."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import index, retrieval

CHUNKS, QUERIES = "paper string, chunk_ix long, text string", "item_id long, paper string, query string"


def corpus(papers=3, chunks=150, seed=3):
    """Chunks of a few words, of which some are in nearly all chunks and some in one stretch of a paper."""
    rng = random.Random(seed)
    rows = []
    for p in range(papers):
        for k in range(chunks):
            words = [rng.choice(["the", "of", "cell", "gene"]) for _ in range(rng.randrange(1, 30))] + [f"topic{k // 20}"] * rng.randrange(3) + [f"w{rng.randrange(300)}" for _ in range(rng.randrange(12))]
            rng.shuffle(words)
            rows.append((f"p{p}", k, " ".join(words)))
    return [*rows, ("p0", chunks, ""), ("p0", chunks + 1, None), ("one", 0, "gene gene"), ("bare", 0, "")]


def asked():
    return [(1, "p0", "topic3 gene"), (2, "p1", "the of the cell topic1 w7 w7"), (3, "p2", "!?"), (4, "one", "gene cell"), (5, "p0", "nowhere"), (6, "bare", "gene"), (7, "absent", "gene"), (8, "p2", "topic5 topic5 w1")]


def plain(spark, chunks, kind, k=5):
    c, q = spark.createDataFrame(chunks, CHUNKS), spark.createDataFrame(asked(), QUERIES)
    return sorted((r.item_id, r.rank, r.chunk_ix, round(r.score, 6)) for r in retrieval.top_k(q, c, getattr(retrieval, kind)(q, c), k).collect())


def indexed(spark, made, kind, k=5):
    q = spark.createDataFrame(asked(), QUERIES)
    return sorted((r.item_id, r.rank, r.chunk_ix, round(r.score, 6)) for r in index.top_k(q, made, k, kind).collect())


@pytest.fixture(scope="module")
def made(spark):
    return index.build(spark.createDataFrame(corpus(), CHUNKS).repartition(3))


@pytest.mark.parametrize("kind", ["bm25", "tfidf"])
def test_index_scores_as_texts_do(spark, made, kind, monkeypatch):
    want = plain(spark, corpus(), kind)
    assert indexed(spark, made, kind) == want
    monkeypatch.setattr(index, "LEAD_RANGES", 1)
    assert indexed(spark, made, kind) == want
    monkeypatch.setattr(index, "MOST_BROADCAST", 0)
    assert indexed(spark, made, kind) == want


def test_ranges_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(index, "RANGE", 4)
    made = index.build(spark.createDataFrame(corpus(), CHUNKS))
    got = {r.item_id: (r.ranges, r.scored) for r in index.skipped(spark.createDataFrame(asked(), QUERIES), made, 3).collect()}
    assert got[8][1] < got[8][0] / 2 and got[1][1] < got[1][0]  # a word of one stretch leaves out most ranges
    assert got[4] == (1, 1) and 5 not in got
    for kind in ("bm25", "tfidf"):
        assert indexed(spark, made, kind, 3) == plain(spark, corpus(), kind, 3)


def test_postings_are_not_shuffled_for_terms(spark, made):
    terms = index.weighed_terms(spark.createDataFrame(asked(), QUERIES), made, "bm25")
    plan = index._hits(terms, made, few=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan and "CartesianProduct" not in plan
    scores = index.bounds(terms, made, "bm25")._jdf.queryExecution().executedPlan().toString()
    assert "chunks:" not in scores  # bounds read no postings


def facts(made):
    found = sorted((r.paper, r.term, r.df) for r in made.terms.collect())
    return found, sorted((r.paper, r.n, r.words, r.parts, None if r.mean_idf is None else round(r.mean_idf, 9)) for r in made.papers.collect()), sorted(map(tuple, made.chunks.collect()))


def test_merge_of_two_is_the_whole(spark, made, tmp_path):
    rows = corpus()
    half = [index.build(spark.createDataFrame([r for r in rows if r[1] % 2 == k], CHUNKS)) for k in (0, 1)]
    both = index.merge(half, f"file://{tmp_path}/both", buckets=3)
    again = index.open_index(spark, f"file://{tmp_path}/both")
    assert facts(both) == facts(again) == facts(made)
    assert indexed(spark, again, "bm25") == indexed(spark, made, "bm25")
    gone = index.merge(half, gone=spark.createDataFrame([("p0",), ("p0",), ("x",)], "paper string"))
    assert facts(gone) == facts(index.build(spark.createDataFrame([r for r in rows if r[0] != "p0"], CHUNKS)))


def test_batches_grow_to_one_build(spark):
    rows = corpus(papers=4, chunks=40)
    first = [r for r in rows if r[0] in ("p0", "p1")]
    older = [("p2", 0, "an older text"), ("p2", 90, "with other chunks")]
    now = index.grown(None, spark.createDataFrame(first + older, CHUNKS))
    now = index.grown(now, spark.createDataFrame([r for r in rows if r[0] not in ("p0", "p1")], CHUNKS), spark.createDataFrame([("p1",)], "paper string"))
    assert facts(now) == facts(index.build(spark.createDataFrame([r for r in rows if r[0] != "p1"], CHUNKS)))


def test_terms_of_a_long_paper_lie_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(index, "RANGE", 2)
    monkeypatch.setattr(index, "PART_RANGES", 3)
    rows = [("p", k, f"hot w{k}") for k in range(60)]
    made = index.build(spark.createDataFrame(rows, CHUNKS))
    assert made.postings.filter("term = 'hot'").groupBy("part").agg(F.sum("n").alias("n")).agg(F.count("n"), F.max("n")).first() == (10, 6)
    q = spark.createDataFrame([(1, "p", "hot w59")], QUERIES)
    assert [r.chunk_ix for r in index.top_k(q, made, 3).orderBy("rank").collect()] == [59, 0, 1]


def test_contexts_by_the_index(spark):
    from folioflow.functions import text
    from folioflow.plans import pipeline

    rng = random.Random(8)
    docs = spark.createDataFrame([(f"p{k}", " ".join(rng.choice(["cell", "gene", "the"]) + (f" w{rng.randrange(90)}" if rng.random() < 0.5 else "") for _ in range(700))) for k in range(4)], "paper string, text string")
    items = spark.createDataFrame([(k, f"p{k % 5}", f"w{k} gene") for k in range(10)], "item_id long, paper string, caption string")
    made = index.build(text.chunk_rows(docs, "paper", "text", size=60, overlap=10))
    how = {"mode": "bm25", "top_k": 3, "chunk_words": 60, "overlap": 10}
    want = sorted(map(tuple, pipeline.contexts(items, docs, **how).collect()))
    assert sorted(map(tuple, pipeline.contexts(items, docs, made=made, **how).collect())) == want and any(r[1] for r in want)


def test_empty_index(spark):
    made = index.build(spark.createDataFrame([], CHUNKS))
    assert made.papers.collect() == [] and index.top_k(spark.createDataFrame(asked(), QUERIES), made, 3).collect() == []


def test_stream_of_batches_equals_one_build(spark, tmp_path):
    from folioflow.streaming import index_stream

    rows = corpus(papers=3, chunks=30)
    source, folder, check = (f"file://{tmp_path}/{n}" for n in ("in", "index", "check"))
    first = [(*r, False) for r in rows if r[0] in ("p0", "p1")] + [("p2", 0, "an older text", False)]
    second = [(*r, None) for r in rows if r[0] not in ("p0", "p1")] + [("p1", None, None, True)]
    assert index_stream.latest(spark, folder) is None
    for batch in (first, second):
        spark.createDataFrame(batch, index_stream.CHUNKS).coalesce(1).write.mode("append").parquet(source)
        index_stream.grow_stream(spark, source, folder, check).awaitTermination()
    made = index_stream.latest(spark, folder)
    assert facts(made) == facts(index.build(spark.createDataFrame([r for r in rows if r[0] != "p1"], CHUNKS)))


def test_terms_are_broadcast_however_long_the_paper(spark, monkeypatch):
    """A query's terms are counted once, not once for each part of the paper, and ranges may lie across Arrow batches."""
    monkeypatch.setattr(index, "RANGE", 2)
    monkeypatch.setattr(index, "PART_RANGES", 1)
    monkeypatch.setattr(index, "MOST_BROADCAST", 2)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        made = index.build(spark.createDataFrame([("p", k, f"hot w{k}") for k in range(60)] + [(None, 0, "hot"), ("p", 60, None)], CHUNKS))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    q = spark.createDataFrame([(1, "p", "hot w59")], QUERIES)
    assert index.weighed_terms(q, made, "bm25").count() == 2
    assert index._ranges(q, made, 3, "bm25")[2]
    assert [r.chunk_ix for r in index.top_k(q, made, 3).orderBy("rank").collect()] == [59, 0, 1]
    assert sum(r.df for r in made.terms.filter("term = 'hot'").collect()) == 61
