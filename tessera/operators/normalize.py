"""Normalising projection of raw reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ratings import truncate_rating
from tessera.functions.text import fold_upper


def normalize_reviews(df: DataFrame) -> DataFrame:
    """Bronze review (+ app, segmento) -> normalised review.

    Drops ``date`` (and ``response`` if still present), turns the double
    rating into a truncated integer string and ASCII-folds / upper-cases title
    and snippet.  A single narrow projection: no shuffle, no Python.
    """
    return df.select(
        "avatar",
        "id",
        "iso_date",
        "app",
        "segmento",
        truncate_rating("rating").alias("rating"),
        "likes",
        fold_upper("title").alias("title"),
        fold_upper("snippet").alias("snippet"),
    )


def rating_truncate(df: DataFrame, rating_col: str = "rating") -> DataFrame:
    """Replace a double rating column by its truncated integer string."""
    return df.withColumn(rating_col, truncate_rating(rating_col))


def accent_fold(df: DataFrame, cols: list[str]) -> DataFrame:
    """ASCII-fold and upper-case the given text columns in place."""
    return df.withColumns({c: fold_upper(F.col(c)) for c in cols})
