"""Table schemas and the readers and writers that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("url", T.StringType()),
])

APPROVED = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("articleId", T.LongType(), False),
    T.StructField("headline", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("isApproved", T.BooleanType()),
])

VECTORS = T.StructType([
    T.StructField("articleId", T.LongType(), False),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

PAIR = ("articleIdNew", "articleIdApproved")
METRICS = ("urlCheck", "contentHash", "embeddingSearch")

RATINGS = T.StructType(
    [T.StructField(name, T.LongType(), False) for name in PAIR]
    + [T.StructField(name, T.DoubleType()) for name in METRICS]
    + [T.StructField(name, T.TimestampType()) for name in ("createdAt", "updatedAt")]
)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARTICLES).parquet(path)


def read_approved(spark: SparkSession, path: str, only_approved: bool = False) -> DataFrame:
    """Approval rows. Every row counts unless `only_approved` asks for the flag."""
    approved = spark.read.schema(APPROVED).parquet(path)
    return approved.where("isApproved") if only_approved else approved


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VECTORS).parquet(path)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RATINGS).parquet(path)


def empty_ratings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RATINGS)


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a new snapshot and read it back.

    An existing path is an error: a pass reads one snapshot and writes the next, so the one
    being read stays whole until the new one is complete. What follows reads the written
    files, so a lost executor costs no recomputation of the pass.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def approved_ids(approved: DataFrame) -> DataFrame:
    """The distinct ids of approved articles."""
    return approved.select(F.col("articleId").cast("long")).distinct()
