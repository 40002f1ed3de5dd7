"""Near-duplicate detection with bottom-k sketches.

1. Every text becomes its set of shingle hashes; the K smallest are its sketch (one hash function). Texts with the
   same set are one node from here on, so groups of copies cost no pairs.
2. Inverted lists of the retained values. A pair at similarity 0.75 shares at least OVERLAP of the K values, but for a
   chance of 2.5e-8 (binomial: of the first K of the union three in four are common). So a node
   enters only the lists of its rarest values, so many that two nodes with OVERLAP common values must meet on one
   (prefix filtering); values of frequent passages are on no list of a text that has enough others.
3. On each list all nodes meet the hub, the one whose lists are the largest; each node's most frequent hub is checked.
   A check estimates the similarity by the union sketch and then verifies it on the full sets. Components of those links.
4. On lists of up to LIST_ROWS nodes all pairs of different components are checked, on longer ones nodes outside the
   largest component with some of it.
5. Nodes of longer lists that still have several components are filtered again, now exactly, on their full sets: their
   rarest shingles (by counts in CELLS cells, one fixed order for all), 25 % of a set and, for the smaller one of a
   pair, 14 %. Texts meet there only if what they share is nearly all of the smaller one. Step 4 follows on these lists.
6. Lists that are still long and still have several components: those outside the largest one are compared with all
   of the list in blocks of bounded size, on full sets by products of 0-1 matrices.
7. Components of all links; every row takes its node's.

Sets of nodes on lists are made and shuffled once, and stored as numbers. Links are verified on full sets before they
count: none is added wrongly, and none is lost but by the chance in 2.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, claim, discard, give_back, lean, private, quoted, stored, text_or_empty
from .components import roots
from .shingles import forget_words, jaccard_at_least, shingle_set

PERCENT = 75
#: Values of a sketch, and how many of them two near duplicates share at least (a share of smaller sketches).
K, OVERLAP = 64, 28
#: Lists of more nodes than this are long; a hub's rows are dealt out by HUB_ROWS; hubs that a node meets there.
LIST_ROWS, HUB_ROWS, TRIES = 32, 1_000, 4
#: Cells that count shingles; nodes and shingles of a block; cells of a matrix.
CELLS, BLOCK_ROWS, BLOCK_SHINGLES, BLOCK_CELLS = 1 << 20, 512, 400_000, 2_000_000
ADDED = ("n_shingles", "component_id", "kept")
_SIGN = np.uint64(1 << 63)


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, h (a hash of the text), n_shingles, digest of the set (null if empty), sketch (ascending; as signed numbers in the same order)."""

    @lean("shingles", forget_words)
    def run(batches):
        for batch in batches:
            sizes, digests, values = [], [], []
            for t in batch.column(2):
                s = shingle_set(t.as_py())
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                values.append((s[:K] ^ _SIGN).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(values, pa.list_(pa.int64()))], ["doc_id", "h", "n_shingles", "digest", "sketch"])

    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("h"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, n_shingles long, digest binary, sketch array<long>")


def estimate(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Jaccard similarity estimated from the bottom-k of the union of two sorted sketches."""
    union = np.union1d(a[:k], b[:k])[:k]
    if not len(union):
        return 0.0
    return np.count_nonzero(np.isin(union, a[:k], assume_unique=True) & np.isin(union, b[:k], assume_unique=True)) / len(union)


def prefix_sizes(size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a set's rarest shingles must hold one in common with any set of at least ``percent`` % similarity.

    The first number serves against smaller sets, the second, fewer, against sets that are at least as large.
    """
    size = np.asarray(size, np.int64)
    return size + -percent * size // 100 + 1, size + -2 * percent * size // (100 + percent) + 1


def _large_enough(a: str, b: str, percent: int):
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


class _Links:
    """Verified links, and the components they give so far. Tables that nothing needs any more are deleted."""

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent, self.tables, self.rows, self.label = sets, percent, [], 0, None

    def add(self, table: DataFrame) -> None:
        """``table``: stored links (a, b)."""
        rows = table.count()
        if rows:
            self.tables.append(table)
            self.rows += rows
            if self.label is not None:
                discard(self.label)
            every = self.tables[0]
            for more in self.tables[1:]:
                every = every.union(more)
            self.label = roots(every, self.rows)

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of their node; a node without links is one of its own."""
        if self.label is None:
            return rows.withColumn("component", F.col("node"))
        out = rows.join(self.label.select(F.col("node").alias("_n"), "root"), F.col("node") == F.col("_n"), "left")
        return out.withColumn("component", F.coalesce("root", "node")).drop("_n", "root")

    def check(self, pairs: DataFrame) -> None:
        """Add those of ``pairs`` (a, b) that the union sketch and then the full sets confirm."""
        pairs = stored(pairs.select("a", "b").distinct(), "pairs")
        total = pairs.count()
        if total:
            self.add(stored(self._verified(pairs, total), "list-links"))
        discard(pairs)

    def _verified(self, pairs: DataFrame, total: int) -> DataFrame:
        """Sets meet by b, then by a. A b of many pairs has its set copied, one for HUB_ROWS of them."""
        hubs = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
        copies = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(HUB_ROWS)).cast("int"))
        left = attach_groups(pairs, hubs, "b", "n", total, "a").select("a", "b", F.pmod(F.xxhash64("a"), copies).cast("int").alias("_s"))
        right = self.sets.join(hubs.withColumnRenamed("b", "node"), "node").select("node", F.col("shingles").alias("sb"), F.explode(F.sequence(F.lit(0), copies - F.lit(1))).alias("_c"))
        both = left.join(right, (F.col("b") == F.col("node")) & (F.col("_s") == F.col("_c"))).select("a", "b", "sb")
        both = both.join(self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb")
        percent, least = self.percent, OVERLAP / K

        @lean("sets")
        def run(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    x, y = x.values.to_numpy(), y.values.to_numpy()
                    keep.append(estimate(x, y) >= least and jaccard_at_least(x, y, percent))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

        return both.mapInArrow(run, "a long, b long")


def _counted(postings: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Stored ``postings`` (value, node, size, first) with n, the nodes of a list that has pairs, and their number."""
    counts = postings.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.max("first").alias("_any")).filter("n > 1 and _any").drop("_any")
    hits = stored(attach_groups(postings, counts, "value", "n", rows, "node"), "hits")
    return hits, hits.count()


def _star(links: _Links, hits: DataFrame, rows: int) -> None:
    """Check each node with the hub that it meets on most lists: the node of a list whose own lists are the largest."""
    weight = hits.groupBy("node").agg(F.sum("n").alias("w"))
    hub = hits.join(weight, "node").groupBy("value").agg(F.max(F.struct("w", "node", "size")).alias("hub"), F.max("n").alias("list_n"))
    met = attach_groups(hits, hub, "value", "list_n", rows, "node").filter((F.col("node") != F.col("hub.node")) & _large_enough("size", "hub.size", links.percent))
    met = met.groupBy(F.col("node").alias("a"), F.col("hub.node").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    links.check(met.groupBy("a").agg(F.max_by("b", "shared").alias("b")))


def _across(links: _Links, hits: DataFrame, rows: int) -> DataFrame | None:
    """Check pairs of different components, and return the rows of long lists that still have several, stored, if any.

    On lists of up to LIST_ROWS nodes these are all pairs whose smaller node (of equal ones that with the smaller
    number) is ``first``. On a longer list nodes outside the largest component meet a random one of it, TRIES a node.
    """
    labelled = stored(links.labelled(hits), "labelled")
    short = labelled.filter(F.col("n") <= LIST_ROWS).groupBy("value").agg(F.array_sort(F.collect_list(F.struct("size", "node", "component", "first"))).alias("m"), F.countDistinct("component").alias("c")).filter("c > 1")
    pair = F.expr(f"flatten(transform(m, (x, i) -> if(x.first, transform(filter(slice(m, i + 2, size(m)), y -> y.component <> x.component and x.size * 100 >= y.size * {links.percent}), y -> struct(y.node as a, x.node as b)), array())))")
    pairs = short.select(F.explode(pair).alias("p")).select("p.a", "p.b")
    long = labelled.filter(F.col("n") > LIST_ROWS)
    if not long.limit(1).count():
        links.check(pairs)
        discard(labelled)
        return None
    order = F.min(F.struct(F.xxhash64("value", "node").alias("o"), "node", "size")).alias("hub")
    parts = long.groupBy("value", "component", "n").agg(F.count(F.lit(1)).alias("m"), order)
    top = parts.groupBy("value").agg(F.max(F.struct("m", "component", "hub")).alias("top"), F.max("n").alias("list_n"))
    met = attach_groups(long, top, "value", "list_n", rows, "node").filter((F.col("component") != F.col("top.component")) & _large_enough("size", "top.hub.size", links.percent))
    tried = met.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("top.hub.node")), 1, TRIES).alias("_h")).select(F.col("node").alias("a"), F.explode("_h").alias("b"))
    links.check(pairs.union(tried))
    again = links.labelled(long.drop("component"))
    several = again.groupBy("value").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.max("n").alias("list_n")).filter("_lo <> _hi").select("value", "list_n")
    left = stored(attach_groups(again, several, "value", "list_n", rows, "node").drop("list_n"), "long-lists")
    discard(labelled)
    return left if left.limit(1).count() else None


def _set_postings(sets: DataFrame, percent: int) -> DataFrame:
    """(value, node, size, first) of each set's rarest shingles, as many as ``prefix_sizes`` asks for."""
    cell = F.col("v").bitwiseAND(F.lit(CELLS - 1))
    counted = sets.select(F.explode("shingles").alias("v")).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    @lean("sets")
    def run(batches):
        for batch in batches:
            values, nodes, sizes, first = [], [], [], []
            for node, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = raw.values.to_numpy()
                most, few = (int(x) for x in prefix_sizes(len(s), percent))
                rare = s[np.lexsort((s, shared.value[s & (CELLS - 1)]))[:most]]
                values.append(rare)
                nodes.append(np.full(len(rare), node))
                sizes.append(np.full(len(rare), len(s)))
                first.append(np.arange(len(rare)) < few)
            if values:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (values, nodes, sizes, first)], ["value", "node", "size", "first"])

    return sets.select("node", "shingles").mapInArrow(run, "value long, node long, size long, first boolean")


def _uncovered(lists: DataFrame, total: int) -> DataFrame:
    """``lists`` (value, node, ...) without those all of whose nodes are on a larger list (of equal ones the first stays).

    The pairs of such a list meet on the larger one, so none is lost.
    """
    sizes = lists.groupBy("value").agg(F.count(F.lit(1)).alias("_size"))
    both = lists.groupBy("node").agg(F.collect_set("value").alias("_its")).select(F.explode("_its").alias("value"), "_its")
    both = both.select("value", F.explode("_its").alias("_other")).groupBy("value", "_other").agg(F.count(F.lit(1)).alias("_both"))
    met = both.join(sizes, "value").filter("_both = _size and _other <> value").join(sizes.select(F.col("value").alias("_other"), F.col("_size").alias("_other_size")), "_other")
    gone = met.filter("_other_size > _size or _other < value").select("value").distinct()
    return attach_groups(lists, sizes.join(gone, "value", "left_anti"), "value", "_size", total, "node").drop("_size")


def _blocks(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of long lists (value, node, size, component).

    Nodes outside their list's largest component ask; they and the list are cut into blocks by a hash of the node, and
    each pair of blocks is compared in one place, which names a link only if it joins components that none before has.
    """
    total = lists.count()
    parts = lists.groupBy("value", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("w"))
    top = parts.groupBy("value").agg(F.max(F.struct("m", "component")).getField("component").alias("top"), F.sum("m").alias("list_n"), F.sum("w").alias("weight"))
    few = stored(attach_groups(_uncovered(lists, total), top, "value", "list_n", total, "node").join(sets.select("node", "shingles"), "node"), "blocks")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("list_n") / F.lit(BLOCK_ROWS)), F.ceil(F.col("weight") / F.lit(BLOCK_SHINGLES))).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - F.lit(1))
    left = few.filter(F.col("component") != F.col("top")).select(F.col("value").alias("v1"), own.alias("i1"), F.explode(every).alias("j1"), F.col("node").alias("node1"), F.col("component").alias("component1"), F.col("shingles").alias("set1"))
    right = few.select(F.col("value").alias("v2"), F.explode(every).alias("i2"), own.alias("j2"), F.col("node").alias("node2"), F.col("component").alias("component2"), F.col("shingles").alias("set2"))

    def marked(sets, common):
        size = np.array([len(x) for x in sets])
        values = np.concatenate(sets)
        at = np.searchsorted(common, values)
        at[at == len(common)] = 0
        hit = common[at] == values
        m = np.zeros((len(size), len(common)), np.float32)
        m[np.repeat(np.arange(len(size)), size)[hit], at[hit]] = 1
        return m, size

    def compared(one, two, up):
        def root(part):
            while up.setdefault(part, part) != part:
                part = up[part]
            return part

        common = np.intersect1d(np.concatenate(one[2]), np.concatenate(two[2]))
        step = max(1, BLOCK_CELLS // max(1, len(common)))
        for i in range(0, len(one[0]) if len(common) else 0, step):
            a, n = marked(one[2][i : i + step], common)
            for j in range(0, len(two[0]), step):
                b, m = marked(two[2][j : j + step], common)
                shared, parts, ids = a @ b.T, two[1][j : j + step], two[0][j : j + step]
                linked = (100 * shared >= percent * (n[:, None] + m[None] - shared)) & (one[1][i : i + step, None] != parts[None])
                for k in np.flatnonzero(linked.any(1)):
                    at = np.flatnonzero(linked[k])
                    for x in at[np.unique(parts[at], return_index=True)[1]]:
                        a_part, b_part = root(int(one[1][i + k])), root(int(parts[x]))
                        if a_part != b_part:
                            up[a_part] = b_part
                            yield int(one[0][i + k]), int(ids[x])

    def by_size(frame, k):
        """Rows by the logarithm of the set's size: partners are in the same class or the next."""
        sets = list(frame[f"set{k}"])
        level = np.floor(np.log([max(1, len(x)) for x in sets]) / np.log(100 / percent)).astype(int)
        ids, parts = frame[f"node{k}"].to_numpy(), frame[f"component{k}"].to_numpy()
        return {v: (ids[at], parts[at], [sets[i] for i in at]) for v in np.unique(level) if len(at := np.flatnonzero(level == v))}

    def compare(askers, members):
        import pandas as pd

        claim("blocks")
        rows, up = [], {}  # components that links of this block have joined already
        if len(askers) and len(members):
            one, two = by_size(askers, 1), by_size(members, 2)
            for v, group in one.items():
                for w in (v - 1, v, v + 1):
                    if w in two:
                        rows += compared(group, two[w], up)
            del one, two
        give_back()
        return pd.DataFrame(rows, columns=["a", "b"]).astype("int64")

    out = stored(left.groupBy("v1", "i1", "j1").cogroup(right.groupBy("v2", "i2", "j2")).applyInPandas(compare, "a long, b long").distinct(), "block-links")
    discard(few)
    return out


def _same_key(sk: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of rows that share a doc_id."""
    of = sk.filter("doc_id is not null and digest is not null").select("doc_id", F.xxhash64("digest").alias("h"))
    twice = of.groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo <> hi").select("doc_id", "lo")
    pairs = of.join(twice, "doc_id").filter("h <> lo").select("h", "lo").distinct()
    side = lambda x, c: nodes.select(F.xxhash64("digest").alias(c), F.col("node").alias(x))
    return pairs.join(side("a", "h"), "h").join(side("b", "lo"), "lo").select("a", "b")


def near_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Words are split at ASCII white space, A-Z in lower case; five make a shingle. Null texts count as empty; texts
    without words link with nothing and are their own component. Of a component the smallest doc_id stays. Rows that
    repeat a doc_id are linked with each other, and all are kept if that id is; a null doc_id is never smallest, and a
    component that has no other gives a null component and is kept. Other columns are not read; an empty table gives
    an empty result. Memory is bounded by one text's set, a block, or an Arrow batch of sets.
    """
    if percent < PERCENT:
        raise ValueError(f"the overlap of sketches is proven for {PERCENT} % and more")
    sk = stored(sketches(df, key, text), "sketches")
    rows = sk.count()
    nodes = sk.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("members"), F.first(F.struct(F.col("doc_id").alias("doc"), "h", F.col("n_shingles").alias("size"), "sketch")).alias("_r"))
    nodes = stored(nodes.select("digest", "doc_id", "members", "_r.*", F.monotonically_increasing_id().alias("node")), "nodes")

    # The rarest values of each sketch: those on one sketch only come first, they need no list.
    values = nodes.select("node", "size", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    counts = stored(values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "values")
    mine = attach_groups(values, counts, "value", "n", rows, "node").groupBy("node", "size", "k").agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("l"))  # at most K in a row
    need = F.ceil(F.col("k") * F.lit(OVERLAP) / F.lit(K)).cast("int")
    room = F.size("l") - need + F.lit(1)  # of k - need + 1 rarest values k - size(l) are on one sketch only
    postings = mine.filter(room > 0).select("node", "size", F.explode(F.slice("l", F.lit(1), room)).alias("_l")).select("_l.value", "node", F.col("size").cast("long").alias("size"), F.lit(True).alias("first"))
    postings = stored(postings, "postings")
    discard(counts)

    # The full sets of the nodes on lists, by one row of each.
    hits, met = _counted(postings, rows)
    wanted = nodes.join(hits.select("node").distinct(), "node", "left_semi").select("node", "digest", "doc", "h")
    sets = stored(_sets(df, wanted, key, text), "sets")
    discard(postings)

    links = _Links(sets, percent)
    links.add(stored(_same_key(sk, nodes), "same-key"))
    if met:
        _star(links, hits, met)
        long = _across(links, hits, met)
        if long is not None:
            again = stored(_set_postings(sets.join(long.select("node").distinct(), "node", "left_semi"), percent), "set-postings")
            more, met = _counted(again, rows)
            longer = _across(links, more, met) if met else None
            if longer is not None:
                links.add(_blocks(longer, sets, percent))
                discard(longer)
            discard(long, again, more)
    discard(hits, sets)

    ids = links.labelled(nodes.select("node", "digest", "members", "doc_id"))
    least = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("parts"))
    final = stored(attach_groups(ids, least, "component", "parts", rows, "node").select("digest", "members", "component_id"), "classes")
    discard(nodes, *links.tables, *([links.label] if links.label is not None else []))
    own = sk.select("doc_id", "n_shingles", "digest")
    out = attach_groups(own.filter("digest is not null"), final, "digest", "members", rows, "doc_id").select("doc_id", "n_shingles", "component_id")
    out = out.union(own.filter("digest is null").select("doc_id", "n_shingles", "doc_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _sets(df: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, shingles) of the ``wanted`` (node, digest, doc, h), from the rows of that doc_id and hash of the text.

    A row that is repeated gives its set as often, which does no harm: a node has no links with itself.
    """
    rows = df.select(F.col(key).cast("long").alias("_d"), F.xxhash64(text_or_empty(text)).alias("_h"), text_or_empty(text).alias("text"))
    met = rows.join(wanted, F.col("doc").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h"))).select("node", "digest", "text")

    @lean("shingles", forget_words)
    def run(batches):
        for batch in batches:
            nodes, sets = [], []
            for node, digest, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = shingle_set(t.as_py())
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == digest:
                    nodes.append(node)
                    sets.append((s ^ _SIGN).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return met.mapInArrow(run, "node long, shingles array<long>")


def without_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that stay, one doc_id of each component, with their own columns; edge cases as in ``near_dedup``."""
    (gone,) = private(df.columns, "_gone")
    away = near_dedup(df, key, text, percent).filter("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return df.join(away, F.col(quoted(key)).cast("long") == F.col(gone), "left_anti")
