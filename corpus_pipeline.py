"""From documents to packed training sequences: toxicity, quality, exact and near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each stage's
result as Parquet to the shared folder and reads it back as the next one's documents. All stages but the last
return the columns of documents, whatever their names. Null texts count as empty in all of them, rows that repeat are
judged alike, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import exact_dedup, neardup, packing, quality, toxicity
from folioflow.llm.common import load, prepare, quoted, scratch


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the recurrent network calls toxic go; an empty text has the score of a window of padding."""
    prepare(spark)
    net = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.scored(docs, net).filter("predicted = 0").select(*map(quoted, docs.columns))


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model rejects go; an empty text is measured like any other."""
    prepare(spark)
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    return quality.scored(docs, model).filter("predicted = 1").select(*map(quoted, docs.columns))


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays, and with it rows that repeat that id; a null id loses to any other."""
    return exact_dedup.exact_dedup(docs).filter("kept").select(*map(quoted, docs.columns))


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the smallest doc_id stays, with all rows of that id; texts without words stay."""
    prepare(spark)
    return neardup.without_near_duplicates(docs)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of at most 2048 tokens; an empty text is one piece of one token, repeated rows are packed each."""
    import public_tokenizers

    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", _toxicity), ("quality", _quality), ("exact_dedup", _exact), ("near_dedup", _near), ("packing", _packing)]

#: Trained models and packing aren't SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
