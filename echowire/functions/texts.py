"""Normalised article text, its hash, and the text handed to an encoder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from echowire.functions.strings import strip

# What stands between headline and text in the hashed string and in the
# encoded string.
HASH_SEPARATOR = "|||"
SENTENCE_SEPARATOR = ". "


def normalize_text(text: Column | str) -> Column:
    """Lower-case ASCII letters and digits separated by single spaces; '' for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " "))


def content_hash(headline: Column | str, text: Column | str) -> Column:
    """SHA-256 (hex) of the normalised headline and text."""
    joined = F.concat(normalize_text(headline), F.lit(HASH_SEPARATOR), normalize_text(text))
    return F.sha2(joined, 256)


def content_score(hash_1: Column, hash_2: Column) -> Column:
    return F.when(hash_1 == hash_2, 1.0).otherwise(0.0)


def combine_text(headline: Column | str, text: Column | str) -> Column:
    """Headline and text as one string, or whichever of them is not blank, or ''."""
    headline = F.col(headline) if isinstance(headline, str) else headline
    text = F.col(text) if isinstance(text, str) else text
    return F.concat_ws(
        SENTENCE_SEPARATOR, F.nullif(strip(headline), F.lit("")), F.nullif(strip(text), F.lit(""))
    )
