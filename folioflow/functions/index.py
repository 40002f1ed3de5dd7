"""A stored inverted index with maxima by range, and exact top-k retrieval that skips ranges.

Chunks are (paper, chunk_ix, text); chunk_ix numbers a paper's chunks. The index holds a row for each paper, term and
range of RANGE chunk numbers: the chunks with the term, how often they have it, their lengths, and the largest count and
share of the term among them. Ranges are the same for all terms, so the sum of a query's bounds over its terms
bounds every chunk of a range. Retrieval (1) sums the bounds, reading no postings, (2) scores the few ranges with the largest
bounds exactly, which gives each query a k-th score that the result can't fall below, (3) scores the other ranges whose
bound reaches that score, and skips the rest. Nothing is approximate: bounds hold for any length of text and any weight.

Postings are bucketed by paper, term and part (PART_RANGES ranges), so the join with many terms of queries moves only the
terms, and a term that all chunks of a long paper have lies in as many buckets as the paper has parts. Few terms are
broadcast, and the postings of those alone are dealt out by range: sums by range and chunk then stay where they are. Every chunk
also stands under the empty term, which no text has: those rows are the list of chunks. Counts are sums, so indexes
of disjoint chunks merge and papers can be taken out again without reading a text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from folioflow.sources.lifecycle import scratch

from .retrieval import DIGITS, FLOOR, K1, MOST_BROADCAST, TOP_K, B, query_terms
from .text import tokens

RANGE, PART_RANGES, LEAD_RANGES, MARGIN, PAGE = 32, 2_048, 8, 1e-8, 4_096
_KEY = ("paper", "term", "part")
_BLOCK = ("max_tf", "max_share", "n", "chunks", "tfs", "sizes")


@dataclass
class Index:
    """postings (paper, term, part, range, max_tf, max_share, n, chunks, tfs, sizes), terms (paper, term, df) and
    papers (paper, n, words, parts, mean_idf), stored below ``folder``; ``table`` names the bucketed postings."""

    spark: SparkSession
    folder: str
    table: str

    @property
    def postings(self) -> DataFrame:
        return self.spark.table(self.table)

    @property
    def terms(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/terms")

    @property
    def papers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/papers")

    @property
    def chunks(self) -> DataFrame:
        """(paper, chunk_ix, dl) of all chunks."""
        rows = self.postings.filter("term = ''").select("paper", F.explode(F.arrays_zip("chunks", "sizes")).alias("_c"))
        return rows.select("paper", F.col("_c.chunks").alias("chunk_ix"), F.col("_c.sizes").alias("dl"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Postings of rows (paper, term, part, range, found: a struct<ix, tf, dl> or an array of them), which may share a range."""
    found = F.collect_list("found")
    found = F.sort_array(F.flatten(found) if isinstance(rows.schema["found"].dataType, ArrayType) else found)
    out = rows.groupBy(*_KEY, "range").agg(found.alias("f"))
    share = F.array_max(F.transform("f", lambda x: x["tf"] / F.nullif(x["dl"], F.lit(0))))  # a chunk without words is under the empty term alone
    return out.select(*_KEY, "range", F.array_max("f.tf").alias("max_tf"), share.alias("max_share"), F.size("f").alias("n"), F.col("f.ix").alias("chunks"), F.col("f.tf").alias("tfs"), F.col("f.dl").alias("sizes"))


def _written(spark: SparkSession, blocks: DataFrame, folder: str, buckets: int) -> Index:
    """The index of ``blocks``, as ``_blocks`` makes them, which lie in one partition for each of the ``buckets`` that are written."""
    index = Index(spark, folder, f"postings_{uuid.uuid4().hex}")
    blocks.write.bucketBy(buckets, *_KEY).option("path", f"{folder}/postings").format("parquet").saveAsTable(index.table)
    spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(f"{folder}/buckets")
    index.postings.filter("term <> ''").groupBy("paper", "term").agg(F.sum("n").alias("df")).write.mode("overwrite").parquet(f"{folder}/terms")
    words = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    papers = index.postings.filter("term = ''").groupBy("paper").agg(F.sum("n").alias("n"), F.sum(words).alias("words"), (F.max("part") + 1).alias("parts"))
    raw = index.terms.join(papers, "paper").groupBy("paper").agg(F.avg(okapi_idf(F.col("n"), F.col("df"))).alias("mean_idf"))
    papers.join(raw, "paper", "left").write.mode("overwrite").parquet(f"{folder}/papers")
    return index


def _count(spark: SparkSession, buckets: int | None) -> int:
    return buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))


def _places(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the papers of ``rows`` (null is one too), and their ranges."""
    papers = pc.dictionary_encode(rows.column(0).combine_chunks(), null_encoding="encode")
    return (papers.combine_chunks() if isinstance(papers, pa.ChunkedArray) else papers).indices.to_numpy(), rows.column(1).to_numpy()


def _range_blocks(rows: pa.Table, width: int) -> pa.RecordBatch:
    """Blocks of whole ranges of ``width``: ``rows`` (paper, range, ix, words) in the order of the first three."""
    rows = rows.combine_chunks()
    names, _ = _places(rows)
    paper, place, ix, words = (rows.column(k).chunk(0) for k in range(4))
    n, coded = len(paper), pc.dictionary_encode(words.flatten())
    dl = np.diff(words.offsets.to_numpy())
    # Every chunk has the empty term once, which gets the number behind the others.
    empty, doc = len(coded.dictionary), np.repeat(np.arange(n), dl)
    key, tf = np.unique(np.concatenate([coded.indices.to_numpy(), np.full(n, empty)]).astype(np.int64) * n + np.concatenate([doc, np.arange(n)]), return_counts=True)
    term, doc = key // n, key % n
    place, ix = place.to_numpy(), ix.to_numpy()
    group = np.cumsum(np.append(False, (place[1:] != place[:-1]) | (names[1:] != names[:-1])))[doc]
    starts = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (group[1:] != group[:-1])))
    size, first = dl[doc], doc[starts]
    share = np.maximum.reduceat(tf / np.where(size > 0, size, np.inf), starts)
    offsets = pa.array(np.append(starts, len(doc)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (ix[doc] - place[doc] * width, tf, size)]
    spelled = pa.concat_arrays([coded.dictionary, pa.array([""], coded.dictionary.type)])
    return pa.RecordBatch.from_arrays([paper.take(pa.array(first)), spelled.take(pa.array(term[starts])), pa.array(place[first]), pa.array(share, mask=share == 0), *lists], ["paper", "term", "range", "max_share", "at", "tfs", "sizes"])


def build(chunks: DataFrame, folder: str | None = None, buckets: int | None = None) -> Index:
    """The index of ``chunks``, each text tokenised once, stored in ``folder`` (or a scratch folder of the session).

    Null texts count as empty. chunk_ix is a whole number of 0 or more, unique within its paper. The texts are dealt out by
    range, so a range's postings are made where its texts are and only whole blocks go to their buckets.
    """
    spark = chunks.sparkSession
    buckets = _count(spark, buckets)
    ix = F.col("chunk_ix").cast("long")
    # One key, not two: of a paper that is a literal nothing would be left, and rows of one range might lie apart.
    t = chunks.select(F.struct("paper", F.floor(ix / F.lit(RANGE)).alias("range")).alias("_g"), ix.alias("ix"), "text").repartition(buckets, "_g").sortWithinPartitions("_g", "ix")
    t = t.select("_g.paper", "_g.range", "ix", tokens("text").alias("words"))

    width = RANGE

    def run(batches):
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if rows.num_rows:
                # The last range may go on in the next batch.
                names, places = _places(rows)
                cut = int(np.argmax((names == names[-1]) & (places == places[-1])))
                rest = rows.slice(cut)
                if cut:
                    yield _range_blocks(rows.slice(0, cut), width)
        if rest is not None:
            yield _range_blocks(rest, width)

    kind = chunks.schema["paper"].dataType.simpleString()
    part = F.floor(F.col("range") / F.lit(PART_RANGES)).cast("int")
    moved = t.mapInArrow(run, f"paper {kind}, term string, range long, max_share double, at array<int>, tfs array<int>, sizes array<int>").repartition(buckets, "paper", "term", part)
    begin = F.col("range") * F.lit(RANGE)
    blocks = moved.select("paper", "term", part.alias("part"), "range", F.array_max("tfs").alias("max_tf"), "max_share", F.size("tfs").alias("n"), F.transform("at", lambda x: begin + x).alias("chunks"), "tfs", "sizes")
    return _written(spark, blocks, folder or scratch(spark, "index"), buckets)


def open_index(spark: SparkSession, folder: str) -> Index:
    """An index that ``build`` or ``merge`` has stored, perhaps in another session."""
    buckets = spark.read.parquet(f"{folder}/buckets").first()["buckets"]
    index = Index(spark, folder, f"postings_{uuid.uuid4().hex}")
    schema = spark.read.parquet(f"{folder}/postings").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {index.table} ({columns}) USING parquet CLUSTERED BY ({', '.join(_KEY)}) INTO {buckets} BUCKETS LOCATION '{folder}/postings'")
    return index


def _rows(index: Index) -> DataFrame:
    found = F.transform(F.arrays_zip("chunks", "tfs", "sizes"), lambda x: F.struct(x["chunks"].alias("ix"), x["tfs"].alias("tf"), x["sizes"].alias("dl")))
    return index.postings.select(*_KEY, "range", found.alias("found"))


def merge(indexes: list[Index], folder: str | None = None, gone: DataFrame | None = None, buckets: int | None = None) -> Index:
    """One index of the chunks of several, which have no chunk in common, less the papers in ``gone`` (paper)."""
    spark, rows = indexes[0].spark, None
    for index in indexes:
        own = _rows(index)
        rows = own if rows is None else rows.unionByName(own)
    if gone is not None:
        rows = rows.join(gone.select("paper").distinct(), "paper", "left_anti")
    buckets = _count(spark, buckets)
    return _written(spark, _blocks(rows.repartition(buckets, *_KEY)), folder or scratch(spark, "index"), buckets)


def grown(index: Index | None, chunks: DataFrame, gone: DataFrame | None = None, folder: str | None = None, buckets: int | None = None) -> Index:
    """``index`` after a batch: papers of ``chunks`` replace their older selves, papers in ``gone`` go; only the batch is tokenised."""
    if index is None:
        return build(chunks, folder, buckets)
    fresh = build(chunks, None, buckets)
    old = fresh.papers.select("paper")
    old = old if gone is None else old.unionByName(gone.select("paper"))
    kept = merge([index], None, old, buckets)
    return merge([kept, fresh], folder, None, buckets)


# --- retrieval ----------------------------------------------------------------------------------------------------


def okapi_idf(n: Column, df: Column) -> Column:
    return F.log((n - df + 0.5) / (df + 0.5))


def _norm(tf: Column, per_share: Column, mean: Column) -> Column:
    """Okapi's share of a term: tf (K1 + 1) / (tf + K1 (1 - B + B dl / mean)), divided by tf; it grows with tf and with tf / dl."""
    return F.lit(K1 + 1) / (F.lit(1.0) + F.lit(K1 * (1 - B)) / tf + F.lit(K1 * B) / (mean * per_share))


#: By kind of score: the weight of a term from n, df, mean_idf, and what a count tf with the share tf / dl is worth at most.
def _weight(kind: str) -> Column:
    if kind == "tfidf":
        return F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1
    idf = okapi_idf(F.col("n"), F.col("df"))
    return F.when(idf < 0, F.col("mean_idf") * FLOOR).otherwise(idf)


def _worth(kind: str, tf: Column, share: Column) -> Column:
    return share if kind == "tfidf" else _norm(tf, share, F.col("mean"))


def weighed_terms(queries: DataFrame, index: Index, kind: str) -> DataFrame:
    """(item_id, paper, term, parts, weight, mean), stored: a query's terms that its paper has, and the parts of the paper."""
    spark = index.spark
    terms = query_terms(queries).join(index.terms, ["paper", "term"]).join(index.papers, "paper")
    mean = F.col("words") / F.col("n")
    rows = terms.select("item_id", "paper", "term", "parts", (F.col("qf") * _weight(kind)).alias("weight"), mean.alias("mean"))
    path = scratch(spark, "query-terms")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _hits(terms: DataFrame, index: Index, few: bool, columns: tuple = (*_BLOCK[:2], *_BLOCK[3:]), ranges: DataFrame | None = None) -> DataFrame:
    """Postings of the terms, with ``columns`` of them; of ``ranges`` (paper, range) alone if given.

    ``few`` terms are broadcast: postings of any of them are dealt out by range, so what is summed up by query and range (or
    chunk) after that needs no exchange. Many terms alone are shuffled, once for each part of their paper.
    """
    if few:
        rows = index.postings.select("paper", "term", "range", *columns).join(F.broadcast(terms.select("paper", "term").distinct()), ["paper", "term"], "left_semi")
        rows = rows if ranges is None else rows.join(F.broadcast(ranges), ["paper", "range"], "left_semi")
        return rows.repartition(_count(index.spark, None), "paper", "range").join(F.broadcast(terms), ["paper", "term"])
    terms = terms.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return index.postings.select(*_KEY, "range", *columns).join(terms.hint("merge"), list(_KEY))


def bounds(terms: DataFrame, index: Index, kind: str, few: bool = True) -> DataFrame:
    """(item_id, paper, range, bound): the most that a chunk of the range may score."""
    best = F.greatest(F.col("weight"), F.lit(0.0)) * _worth(kind, F.col("max_tf").cast("double"), F.col("max_share"))
    return _hits(terms, index, few, ("max_tf", "max_share")).groupBy("item_id", "paper", "range").agg(F.sum(best).alias("bound"))


def _wanted(hits: DataFrame, ranges: DataFrame, few: bool) -> DataFrame:
    """``hits`` of the ``ranges`` (item_id, range), which are broadcast as bits if they are ``few``: a row for PAGE of a query's ranges."""
    if not few:
        return hits.join(ranges, ["item_id", "range"], "left_semi")
    words = ranges.groupBy("item_id", F.expr("range div 64").alias("_w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(range % 64 as int))")).alias("_b"))
    pages = words.groupBy("item_id", F.expr(f"_w div {PAGE // 64}").alias("_page")).agg(F.map_from_entries(F.collect_list(F.struct(F.expr(f"cast(_w % {PAGE // 64} as int)"), "_b"))).alias("_m"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(PAGE // 64 - 1)), lambda k: F.coalesce(F.try_element_at("_m", k), F.lit(0).cast("long")))
    pages = pages.select("item_id", "_page", bits.alias("_bits"))
    rows = hits.withColumn("_page", F.expr(f"range div {PAGE}")).join(F.broadcast(pages), ["item_id", "_page"])
    return rows.filter(F.expr(f"getbit(get(_bits, cast(range % {PAGE} div 64 as int)), cast(range % 64 as int)) = 1")).drop("_page", "_bits")


def _scores(terms: DataFrame, index: Index, kind: str, ranges: DataFrame, few: bool, lead: bool) -> DataFrame:
    """(item_id, paper, chunk_ix, score) of the chunks with a term in the ``ranges`` (item_id, paper, range); ``lead``: they are few."""
    hits = _hits(terms, index, few, ("chunks", "tfs", "sizes"), ranges.select("paper", "range").distinct() if lead else None)
    rows = _wanted(hits, ranges.select("item_id", "range"), few)
    each = rows.select("item_id", "paper", "range", "weight", "mean", F.explode(F.arrays_zip("chunks", "tfs", "sizes")).alias("_c"))
    tf = F.col("_c.tfs").cast("double")
    share = F.col("weight") * _worth(kind, tf, tf / F.col("_c.sizes"))
    return each.groupBy("item_id", "paper", "range", F.col("_c.chunks").alias("chunk_ix")).agg(F.round(F.sum(share), DIGITS).alias("score")).drop("range")


def _ranges(queries: DataFrame, index: Index, k: int, kind: str) -> tuple[DataFrame, DataFrame, bool]:
    """The stored terms and the stored ``bounds`` with ``scored``: whether a range may hold one of its query's k best chunks."""
    spark = index.spark
    terms = weighed_terms(queries, index, kind)
    few = terms.count() <= MOST_BROADCAST
    path = scratch(spark, "bounds")
    found = bounds(terms, index, kind, few)
    found.write.parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    order = Window.partitionBy("item_id").orderBy(F.desc("bound"), "range")
    leading = stored.withColumn("_lead", F.row_number().over(order)).filter(F.col("_lead") <= LEAD_RANGES)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"))
    worst = _scores(terms, index, kind, leading, few, True).withColumn("_r", F.row_number().over(best)).filter(F.col("_r") == k)
    # Only a k-th score above zero can shut out chunks: others tie with, or lose to, chunks without any of the terms.
    least = worst.filter("score > 0").select("item_id", (F.col("score") * (1 - MARGIN) - MARGIN).alias("_least"))
    return terms, stored.join(least, "item_id", "left").withColumn("scored", F.col("_least").isNull() | (F.col("bound") >= F.col("_least"))).drop("_least"), few


def skipped(queries: DataFrame, index: Index, k: int = TOP_K, kind: str = "bm25") -> DataFrame:
    """(item_id, ranges, scored): ranges that hold a term of the query, and how many of them are scored."""
    _, ranges, _ = _ranges(queries, index, k, kind)
    return ranges.groupBy("item_id").agg(F.count(F.lit(1)).alias("ranges"), F.count_if("scored").alias("scored"))


def top_k(queries: DataFrame, index: Index, k: int = TOP_K, kind: str = "bm25") -> DataFrame:
    """(item_id, paper, chunk_ix, score, rank) by ``kind`` (bm25, tfidf): best first, ties by chunk_ix; chunks without any of
    the terms score 0, so a query without terms gets the first k chunks of its paper.

    Of the chunks that score 0 only a paper's first 2k matter: at most k of those have another score and rank before.
    """
    terms, ranges, few = _ranges(queries, index, k, kind)
    scores = _scores(terms, index, kind, ranges.filter("scored"), few, False)
    first = index.chunks.withColumn("_r", F.row_number().over(Window.partitionBy("paper").orderBy("chunk_ix"))).filter(F.col("_r") <= 2 * k)
    # Of the scores only those of these first chunks and the k best others can matter, and no more are shuffled.
    last = first.groupBy("paper").agg(F.max("chunk_ix").alias("_last")).join(queries.select("paper").distinct(), "paper", "left_semi")
    scores = scores.join(F.broadcast(last) if few else last, "paper")
    lead = Window.partitionBy("item_id").orderBy((F.col("chunk_ix") > F.col("_last")), F.desc("score"), "chunk_ix")
    scores = scores.withColumn("_r", F.row_number().over(lead)).filter(F.col("_r") <= 3 * k).select("item_id", "paper", "chunk_ix", "score")
    zero = queries.select("item_id", "paper").join(first, "paper").select("item_id", "paper", "chunk_ix", F.lit(0.0).alias("score"))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "chunk_ix")
    every = scores.unionByName(zero).groupBy("item_id", "paper", "chunk_ix").agg(F.sum("score").alias("score"))
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
