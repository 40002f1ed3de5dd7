"""Every query that has SQL gives the same rows as DuckDB."""

import os
import re

import duckdb
import pandas as pd
import pytest

from folioflow.operators import layout
from folioflow.plans import more_queries, queries  # noqa: F401  (registers its queries)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in os.listdir(small):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{small}/{f}')")
    return con


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(zip(*[[None if pd.isna(x) else x for x in frame[c].tolist()] for c in names], strict=True), key=repr)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, small, duck, name):
    assert rows(queries.QUERIES[name](spark, small).toPandas()) == rows(duck.sql(queries.SQL[name]).df())


def test_every_query_has_sql():
    assert set(queries.SQL) == set(queries.QUERIES)


@pytest.mark.parametrize("name", ["abstract_section", "section_map", "retrieved_contexts"])
def test_words_like_headings(spark, small, tmp_path, name):
    """Texts whose parts begin with words that would be headings at the beginning of a line."""
    odd = ["1.43.173.185", "2", "Results", "methods", "Abstract", "Keywords", "Material and methods", "references", "⁠", "⁠results", "1", "Introduction"]
    plain = [f"w{k}" for k in range(1_200)]
    texts = {k: o for k, o in enumerate(odd)} | {12 + k: f"{o} and so on" for k, o in enumerate(odd)}
    for at in (0, 30, 280, 420, 500, 670, 800, 890, 1_190):
        texts |= {len(texts) + k: " ".join([*plain[:at], o, *plain[at:]]) for k, o in enumerate(odd)}
    d = str(tmp_path)
    docs = pd.DataFrame({"doc_id": list(texts), "text": list(texts.values())})
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, "and results w3") for k in texts], "item_id long, text string").coalesce(1).write.parquet(f"{d}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    assert rows(queries.QUERIES[name](spark, d).toPandas()) == rows(con.sql(queries.SQL[name]).df())


@pytest.mark.parametrize("name", ["prev_boundary", "figure_region", "fallback_region", "next_page", "region_cascade", "extract_figures"])
def test_layout_is_dealt_out(spark, small, name):
    """Shuffles of boxes begin with many partitions, whatever the session's number is."""
    plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    found = [int(x) for x in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), ENSURE", plan)]
    assert found and min(found) >= 400


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_out_once(spark, small):
    """The result reads no line of the table again nor the stored boxes, which are gone, and tables and pictures of stored boxes are labelled where they lie."""
    before = {t.name for t in spark.catalog.listTables()}
    assert "l_orderkey" not in plan(queries.QUERIES["extract_figures"](spark, small))
    assert {t.name for t in spark.catalog.listTables()} == before
    boxes = queries._stored_boxes(spark, small)
    assert "Exchange" not in plan(layout.labelled_pictures(queries._pictures(spark, small, boxes)))
    assert "Exchange" not in plan(layout.labelled_tables(more_queries._layout_tables(spark, small, boxes)))
