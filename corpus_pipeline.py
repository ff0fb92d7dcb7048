"""The corpus pipeline: stages that each work on all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, minhash, mixing, quality, tokens
from tidelog.llm.storage import store
from tidelog.session import bounded_batches, work_dir

#: documents that score less are rejected
LEAST_SCORE = 0.3
#: shares of tokens that the mixture aims at, and tokens aimed at for each token there is
TARGETS = {"clean": 0.98, "low": 0.005, "toxic": 0.015}
BUDGET = 1.1


def _free(docs: DataFrame, name: str) -> str:
    """The name, or one like it that no column of the documents has (Spark takes upper and lower case for the same)."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _numbered(docs: DataFrame, name: str, number: str) -> DataFrame:
    """The documents, written once, with a number for each row."""
    return store(docs.withColumn(number, F.monotonically_increasing_id()), name).rows


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from labelled documents outside a fold.

    A null text scores as an empty one, and repeated rows score alike. Without labels of both classes all documents
    get one score. No documents give none; other columns go through whatever their names.
    """
    bounded_batches(spark)
    score = _free(docs, "_score")
    model, _ = quality.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score_quality(docs, model, score_col=score, keep_text=True)
    return scored.filter(F.col(score) >= LEAST_SCORE).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Texts without words are copies of nothing and stay, as do documents of their own. Of rows with the same smallest id
    one stays; rows without an id come after those with one. No documents give none.
    """
    number = _free(docs, "_number")
    numbered = _numbered(docs, "numbered", number)
    groups = minhash.near_groups(numbered, number_col=number)
    stay = groups.filter("kept").select(F.col("row").alias(number))
    return numbered.join(stay, number, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold nothing like a benchmark item."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture wants them.

    The budget is a tenth more than there is, so that documents of the domain that is wanted most are
    there at least once; those of the others may go. Rows that are equal in all columns are a group: it gets the
    copies of its rates together, the fraction decided by a hash of the row, so how the rows lie in files does not
    matter. A null text has no tokens and is there as often as the prior says. No documents give none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    number, mark, often = (_free(docs, name) for name in ("_number", "_mark", "_often"))
    numbered = _numbered(docs.withColumn(mark, F.xxhash64(*docs.columns)), "numbered", number)
    rates, _ = mixing.mixed_rates(numbered, labels, TARGETS, others=[number, mark], budget=BUDGET)
    groups = rates.groupBy("doc_id", mark).agg(F.min(number).alias(number), F.sum("rate").alias("rates"))
    wanted = groups.select(number, mixing.copies("rates", "doc_id", mark).alias(often)).filter(F.col(often) > 0)
    repeated = numbered.join(wanted, number).withColumn(often, F.explode(F.sequence(F.lit(1), F.col(often))))
    return repeated.select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files, read back: where each document is and a checksum of its ids."""
    path = work_dir(spark, "tokens")
    tokens.write_tokens(docs, path)
    return tokens.checksums(tokens.read_tokens(spark, path))


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("benchmark", without_benchmark),
    ("mixture", mixed),
    ("token_ids", token_ids),
]
#: models and tokenizers are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name).rows
    return STAGES[-1][1](spark, docs, sf_dir)
