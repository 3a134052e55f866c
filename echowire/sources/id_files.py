"""Id files: CSV with an `articleId` column, in any position, among any other columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echowire.functions.strings import strip

ID_COLUMN = "articleId"


def read_id_file(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """The raw id strings of one or more CSV files, one row per line.

    Header names may carry blanks around them. Set `multiline` for files with line breaks
    inside quoted fields; such files cannot be split between tasks.
    """
    lines = spark.read.csv(
        path, header=True, encoding="UTF-8", quote='"', escape='"', multiLine=multiline
    )
    for name in lines.columns:
        if name.strip() == ID_COLUMN:
            return lines.select(F.col(f"`{name}`").alias("rawId"))
    raise ValueError(f"no column named {ID_COLUMN} among {lines.columns}")


def parsed_id(raw: Column) -> Column:
    """A whole number with optional sign and single underscores between digits, else NULL."""
    text = strip(raw)
    digits = F.replace(text, F.lit("_"), F.lit(""))
    return F.when(text.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*$"), digits.try_cast("bigint"))


def parse_ids(lines: DataFrame) -> DataFrame:
    """Each line with its id and what became of it: `ok`, `blank` or `malformed`."""
    parsed = lines.withColumn(ID_COLUMN, parsed_id(F.col("rawId")))
    blank = F.coalesce(strip(F.col("rawId")), F.lit("")) == ""
    return parsed.withColumn(
        "outcome",
        F.when(blank, "blank").when(F.col(ID_COLUMN).isNull(), "malformed").otherwise("ok"),
    )


def distinct_ids(lines: DataFrame) -> DataFrame:
    """The ids of a file, each once."""
    return parse_ids(lines).where("outcome = 'ok'").select(ID_COLUMN).distinct()


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that hold something other than an id."""
    return parse_ids(lines).where("outcome = 'malformed'").select("rawId")


def known_ids(ids: DataFrame, articles: DataFrame) -> DataFrame:
    """Ids that exist as articles."""
    return ids.join(articles.select(F.col("id").alias(ID_COLUMN)), ID_COLUMN, "left_semi")


def unknown_ids(ids: DataFrame, articles: DataFrame) -> DataFrame:
    """Ids without an article."""
    return ids.join(articles.select(F.col("id").alias(ID_COLUMN)), ID_COLUMN, "left_anti")


def id_file_quality(lines: DataFrame, articles: DataFrame) -> DataFrame:
    """One row on a whole id file: line counts by outcome, repeats, known and unknown ids.

    `valid_format` says that no line is malformed. Lines are counted per id before the join
    with the articles, so an id repeated many times meets that join as one row.
    """
    per_id = parse_ids(lines).groupBy("outcome", ID_COLUMN).agg(F.count("*").alias("lines"))
    known = articles.select(F.col("id").alias(ID_COLUMN)).distinct().withColumn("known", F.lit(True))
    judged = per_id.join(known, ID_COLUMN, "left")
    ok = F.col("outcome") == "ok"

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    counts = judged.agg(
        total(F.col("lines")).alias("line_count"),
        total(F.when(F.col("outcome") == "blank", F.col("lines"))).alias("blank"),
        total(F.when(F.col("outcome") == "malformed", F.col("lines"))).alias("malformed"),
        total(F.when(ok, F.col("lines") - 1)).alias("repeated"),
        F.count_if(ok & F.col("known").isNotNull()).alias("known"),
        F.count_if(ok & F.col("known").isNull()).alias("unknown"),
    )
    return counts.withColumn("valid_format", F.col("malformed") == 0)
