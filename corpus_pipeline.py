"""From `documents` to token ids: good documents, without repeated lines, near copies and test items, encoded.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, and returns the columns of
`documents`; the last one returns the tokens. Texts that a stage changes are changed for all stages after it.

Cases: rows without a doc_id are told apart by their texts; of rows with the same id and text one stays. Extra columns of
docs are carried along. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echowire.llm import bpe_tree, decontaminate, line_dedup, minhash_dedup, rule_quality
from echowire.llm.frames import table
from echowire.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones among them, does not reject."""
    return rule_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more stay at their first occurrence only; documents left empty go.

    The first occurrence is kept so that of a group of exact copies one stays whole.
    """
    cleaned = line_dedup.drop_lines(docs, keep_first=True)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_dedup.drop_near_duplicates(docs)


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and digests of the ids and of the decoded bytes."""
    return bpe_tree.digests(docs, *bpe_tree.vocabulary(), with_ids=True)


STAGES = [
    ("quality", quality),
    ("repeated_lines", repeated_lines),
    ("near_copies", near_copies),
    ("test_items", test_items),
    ("tokens", tokens),
]

#: Learning, minimum hashing and byte-pair merges have no SQL form; tests compare with plain counterparts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result of each but the last is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
