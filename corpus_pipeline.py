"""The corpus pipeline: documents through five operators of ``quayside.llm``.

toxicity -> near duplicates -> repeated passages -> benchmark contamination -> pieces. Each
stage gets all that its predecessor kept, as written Parquet, and its decisions take effect:
toxic rows go, of each group of near copies the row with the smallest id stays, repeated
passages are cut from the texts, contaminated rows go, and the last stage encodes what is left.
All but the last return the columns of ``documents``. A text from which words are cut keeps its
other words, joined by one space, and its new length in ``n_chars``.

SQL cannot express the first and last stage: ``ORACLE_SQL`` is None, and ``tests/llm`` runs the
pipeline against brute-force stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, exchange, jaccard_join, piece_codec, substring_dedup, toxicity
from quayside.llm.shipping import ship
from quayside.session import scratch_path


# Batches of rows for Python workers. Their buffers outlive a stage in the executor's JVM and in its
# idle workers, and the stages follow one another in the same executors.
BATCH_BYTES = 2 << 20


def _begin(spark: SparkSession) -> None:
    ship(spark, BATCH_BYTES)
    exchange.settle(spark)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that do not score as toxic. Labels name documents by id; the model learns from the
    rows that this stage gets."""
    _begin(spark)
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return jaccard_join.keep_first(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    cut = substring_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return piece_codec.stage(spark, docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeats),
    ("decontaminate", contaminated),
    ("sentencepiece", pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
