"""Lexical retrieval: TF-IDF and BM25 scores, top-k, reordering and layered context.

For many queries to the same chunks there is a stored index (``index``); the scores here are made from the texts, for
chunks that are asked once.

Chunks are (paper, chunk_ix, text), queries (item_id, paper, query). Scores come from a join on the term, so only
chunks that share a term with a query are touched; chunks without one have score 0 and fill up an item's top k from
the first chunks of its paper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import tokens

TOP_K, K1, B, FLOOR, DIGITS = 10, 1.5, 0.75, 0.25, 10
MOST_BROADCAST = 200_000  # terms of queries that are broadcast; more are joined by a shuffle
# The titles of the layered context.
LOCAL, GLOBAL, BETWEEN, CHUNK_RULE = "FIGURE/TABLE LOCAL CONTEXT (BM25 top-{k} chunks):\n", "PAPER GLOBAL CONTEXT MAP:\n", "\n\n====\n\n", "\n\n---\n\n"


def postings(chunks: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(paper, chunk_ix, term, tf, dl): how often a term occurs in a chunk of dl words; of ``wanted`` (paper, term) alone if given."""
    t = chunks.select("paper", "chunk_ix", tokens("text").alias("_t"))
    rows = t.select("paper", "chunk_ix", F.size("_t").alias("dl"), F.explode("_t").alias("term"))
    if wanted is not None:
        few = wanted.count() <= MOST_BROADCAST
        rows = rows.join(F.broadcast(wanted) if few else wanted, ["paper", "term"], "left_semi")
    return rows.groupBy("paper", "chunk_ix", "term", "dl").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(index: DataFrame) -> DataFrame:
    """(paper, term, df, tf) of postings: chunks with the term, and its occurrences."""
    return index.groupBy("paper", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))


def frequencies(chunks: DataFrame) -> DataFrame:
    """(paper, term, df): chunks with the term, counted without postings."""
    rows = chunks.select("paper", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    return rows.groupBy("paper", "term").agg(F.count(F.lit(1)).alias("df"))


def sizes(chunks: DataFrame) -> DataFrame:
    """(paper, n, avgdl): chunks of a paper and their mean number of words."""
    return chunks.groupBy("paper").agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(tokens("text"))).alias("avgdl"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, paper, term, qf): a query's terms with their repeats."""
    return queries.select("item_id", "paper", F.explode(tokens("query")).alias("term")).groupBy("item_id", "paper", "term").agg(F.count(F.lit(1)).alias("qf"))


def _summed(queries: DataFrame, found: DataFrame, weights: DataFrame, score: Column) -> DataFrame:
    """``weights`` are (paper, term, ...). The query side is joined with them first: few terms are left to look up."""
    terms = query_terms(queries).join(weights, ["paper", "term"])
    return terms.join(found, ["paper", "term"]).groupBy("item_id", "paper", "chunk_ix").agg(F.round(F.sum(F.col("qf") * score), DIGITS).alias("score"))


def _found(queries: DataFrame, chunks: DataFrame) -> DataFrame:
    """Postings of the queries' terms: no others are counted or shuffled."""
    return postings(chunks, query_terms(queries).select("paper", "term").distinct())


def tfidf(queries: DataFrame, chunks: DataFrame) -> DataFrame:
    """(item_id, paper, chunk_ix, score) of chunks that share a term: sum of tf/dl * (ln((n+1)/(df+1)) + 1)."""
    found = _found(queries, chunks)
    weights = term_stats(found).drop("tf").join(sizes(chunks), "paper")
    weights = weights.select("paper", "term", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    return _summed(queries, found, weights, F.col("tf") / F.col("dl") * F.col("idf"))


def bm25(queries: DataFrame, chunks: DataFrame) -> DataFrame:
    """The same by Okapi BM25; a negative idf becomes FLOOR times the paper's mean idf, which all its terms make."""
    found = _found(queries, chunks)
    stats = frequencies(chunks).join(sizes(chunks), "paper")
    stats = stats.withColumn("idf", F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    mean = stats.groupBy("paper").agg(F.avg("idf").alias("mean"))
    weights = stats.join(mean, "paper").select("paper", "term", "avgdl", F.when(F.col("idf") < 0, F.col("mean") * FLOOR).otherwise(F.col("idf")).alias("idf"))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl"))
    return _summed(queries, found, weights, F.col("idf") * F.col("tf") * (K1 + 1) / norm)


def top_k(queries: DataFrame, chunks: DataFrame, scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """(item_id, paper, chunk_ix, score, rank): best first, ties by chunk_ix; without query terms the first k chunks.

    Zero scores matter only among a paper's first 2k chunks: at most k of those have a score above zero ranks.
    """
    first = chunks.select("paper", "chunk_ix", F.row_number().over(Window.partitionBy("paper").orderBy("chunk_ix")).alias("_r")).filter(F.col("_r") <= 2 * k)
    zero = queries.select("item_id", "paper").join(first.drop("_r"), "paper").select("item_id", "paper", "chunk_ix", F.lit(0.0).alias("score"))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "chunk_ix")
    every = scores.unionByName(zero).groupBy("item_id", "paper", "chunk_ix").agg(F.sum("score").alias("score"))
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def reordered(ranked: DataFrame) -> DataFrame:
    """``ranked`` with out_pos (from 1): best first, second last, the others between in document order; two or fewer stay."""
    item = Window.partitionBy("item_id")
    place = F.when(F.count(F.lit(1)).over(item) < 3, F.struct(F.col("rank").alias("a"), F.lit(0).cast("long").alias("b")))
    place = place.otherwise(F.struct(F.when(F.col("rank") == 1, 0).when(F.col("rank") == 2, 2).otherwise(1).alias("a"), F.col("chunk_ix").cast("long").alias("b")))
    return ranked.withColumn("_p", place).withColumn("out_pos", F.row_number().over(item.orderBy("_p"))).drop("_p")


def retrieve(queries: DataFrame, chunks: DataFrame, k: int = TOP_K, score=bm25) -> DataFrame:
    return reordered(top_k(queries, chunks, score(queries, chunks), k))


def gathered(retrieved: DataFrame, chunks: DataFrame) -> DataFrame:
    """(item_id, local, retrieved_chunks, retrieved_words): the retrieved texts in their order."""
    rows = retrieved.join(chunks.select("paper", "chunk_ix", "text"), ["paper", "chunk_ix"])
    parts = rows.groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("out_pos", "text"))), lambda x: x["text"]).alias("_t"))
    local = F.array_join("_t", CHUNK_RULE)
    return parts.select("item_id", local.alias("local"), F.size("_t").cast("long").alias("retrieved_chunks"), F.aggregate("_t", F.lit(0).cast("long"), lambda a, t: a + F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))).alias("retrieved_words"))


def layered(paper_map: Column, local: Column, k: int = TOP_K) -> Column:
    """The paper's map and the local chunks below their titles; what is empty is left out."""
    top = F.when(F.coalesce(paper_map, F.lit("")) != "", F.concat(F.lit(GLOBAL), paper_map))
    low = F.when(F.coalesce(local, F.lit("")) != "", F.concat(F.lit(LOCAL.format(k=k)), local))
    return F.concat_ws(BETWEEN, top, low)
