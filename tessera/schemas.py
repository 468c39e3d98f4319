"""Declared schemas of the review tables.

Fixed values: field names, order, types and nullability below must equal the
job being replaced, because they define what is read from bronze, what is
read back as history and what is written to silver.
"""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: one change-history entry --------------------------------
HISTORY_ENTRY = StructType([
    StructField("title", StringType(), True),
    StructField("snippet", StringType(), True),
    StructField("app", StringType(), True),
    StructField("segmento", StringType(), True),
    StructField("rating", StringType(), True),
    StructField("iso_date", StringType(), True),
])

HISTORY_ARRAY = ArrayType(HISTORY_ENTRY, True)

# --- fixed values: raw (bronze) review as delivered by the collector -------
BRONZE_SCHEMA = StructType([
    StructField("avatar", StringType(), True),
    StructField("date", StringType(), True),
    StructField("id", StringType(), True),
    StructField("iso_date", StringType(), True),
    StructField("likes", LongType(), True),
    StructField("rating", DoubleType(), True),
    StructField("response", MapType(StringType(), StringType(), True), True),
    StructField("snippet", StringType(), True),
    StructField("title", StringType(), True),
])

# --- fixed values: silver output (valid rows) ------------------------------
SILVER_SCHEMA = StructType([
    StructField("id", StringType(), True),
    StructField("app", StringType(), False),
    StructField("segmento", StringType(), False),
    StructField("rating", StringType(), True),
    StructField("iso_date", StringType(), True),
    StructField("title", StringType(), True),
    StructField("snippet", StringType(), True),
    StructField("historical_data", HISTORY_ARRAY, True),
])

# --- fixed values: silver partitions read back as history ------------------
HISTORY_READ_SCHEMA = StructType([
    StructField("avatar", StringType(), True),
    StructField("id", StringType(), True),
    StructField("iso_date", StringType(), True),
    StructField("app", StringType(), False),
    StructField("segmento", StringType(), False),
    StructField("rating", StringType(), True),
    StructField("likes", LongType(), True),
    StructField("title", StringType(), True),
    StructField("snippet", StringType(), True),
    StructField("historical_data", HISTORY_ARRAY, False),
    StructField("odate", StringType(), True),
])

# Columns of a normalised review (output of ``normalize_reviews``).
NORMALIZED_COLUMNS = [
    "avatar", "id", "iso_date", "app", "segmento", "rating", "likes", "title", "snippet",
]

# Columns that must be non-null for a row to be valid, and the subset whose
# nulls route a row to quarantine (``segmento`` is not part of it).
VALID_REQUIRED = ["id", "rating", "app", "iso_date", "title", "segmento", "snippet"]
CRITICAL_COLUMNS = ["id", "rating", "app", "iso_date", "title", "snippet"]

# Column order of the quarantine (invalid) output.
INVALID_COLUMNS = ["id", "rating", "app", "iso_date", "title", "segmento", "snippet"]

# Fields compared between a new review and an earlier version of it.
CHANGE_FIELDS = ["title", "snippet", "rating", "iso_date"]

PARTITION_COLUMN = "odate"


def history_array_ddl() -> str:
    """DDL string of the history array type, for ``cast``."""
    return HISTORY_ARRAY.simpleString()
