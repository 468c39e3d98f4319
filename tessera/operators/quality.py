"""Data-quality checks and the valid / quarantine split.

All checks are aggregations that Spark partially aggregates map-side; none
collects rows to the driver.  Check results are small DataFrames (one row
per check) so they can be joined into reports or written as audit rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ratings import rating_is_malformed
from tessera.schemas import (
    CRITICAL_COLUMNS,
    HISTORY_ARRAY,
    INVALID_COLUMNS,
    SILVER_SCHEMA,
    VALID_REQUIRED,
)

# --- fixed values: check names, result codes and messages of the validation report
CHECK_DUPLICATE = "duplicate_check"
CHECK_NULL = "null_check"
CHECK_TYPE = "type_consistency_check"
CODE_OK = 200
CODE_BAD_DATA = 400
CODE_CONFLICT = 409
MSG_DUP_FOUND = "Registros duplicados encontrados: {n} registros com base no 'id'."
MSG_DUP_NONE = "Nenhum registro duplicado encontrado."
MSG_NULL_FOUND = "Valores nulos encontrados nas colunas: {issues}."
MSG_NULL_NONE = "Nenhum valor nulo encontrado nas colunas criticas."
MSG_TYPE_FOUND = "Valores não numericos encontrados na coluna 'rating'."
MSG_TYPE_NONE = "Consistencia dos tipos de dados verificada com sucesso."
REPORT_PASSED = "PASSOU"
REPORT_FAILED = "FALHOU"


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def duplicate_message(n: Column) -> Column:
    return F.format_string(MSG_DUP_FOUND.replace("{n}", "%d"), n)


def null_message(counts: dict[str, Column]) -> Column:
    before, after = MSG_NULL_FOUND.split("{issues}")
    return F.concat(F.lit(before), null_issues_text(counts), F.lit(after))


# ---------------------------------------------------------------- duplicates
def duplicate_keys(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys that occur more than once (NULL keys excluded): ``keys + [n]``.

    ``groupBy().count()`` is partial-aggregated per map task, so even a key
    holding a third of all rows reaches the shuffle as one row per task.
    """
    keys = keys or ["id"]
    not_null = _all_not_null(keys)
    return (df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def _all_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """All rows whose key is duplicated (left semi join with the key list).

    The big side streams; the key list is unique, so AQE may broadcast it when
    its runtime size is under the broadcast threshold, or split a skewed
    partition of the streamed side otherwise.
    """
    keys = keys or ["id"]
    return df.join(duplicate_keys(df, keys).select(*keys), keys, "left_semi")


def duplicate_check(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: check, status, code, message, n_failed (= duplicated keys)."""
    n = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n_failed"))
    return n.select(*_status_columns(CHECK_DUPLICATE, F.col("n_failed"), CODE_CONFLICT,
                                     duplicate_message(F.col("n_failed")),
                                     F.lit(MSG_DUP_NONE)),
                    "n_failed")


# ---------------------------------------------------------------- nulls
def null_count_columns(cols: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column: ``column, n_null`` (single pass, then unpivot)."""
    cols = cols or CRITICAL_COLUMNS
    wide = df.agg(*null_count_columns(cols))
    return wide.unpivot([], [f"null_{c}" for c in cols], "column", "n_null").select(
        F.regexp_replace("column", "^null_", "").alias("column"), "n_null")


def null_issues_text(counts: dict[str, Column]) -> Column:
    """``{'rating': 40, 'title': 52}``-style text of the non-zero counts."""
    parts = [F.when(n > 0, F.concat(F.lit(f"'{c}': "), n.cast("string"))) for c, n in counts.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def null_check(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: check, status, code, message, n_failed (= columns with nulls), null_<col>..."""
    cols = cols or CRITICAL_COLUMNS
    wide = df.agg(*null_count_columns(cols))
    counts = {c: F.col(f"null_{c}") for c in cols}
    n_bad = reduce(lambda a, b: a + b, [F.when(n > 0, 1).otherwise(0) for n in counts.values()])
    return wide.select(*_status_columns(CHECK_NULL, n_bad, CODE_BAD_DATA, null_message(counts), F.lit(MSG_NULL_NONE)),
                       n_bad.cast("long").alias("n_failed"), *counts.values())


# ---------------------------------------------------------------- types
def type_check(df: DataFrame, col: str = "rating") -> DataFrame:
    """One row: n_null, n_malformed, n_failed (= both), status, code, message.

    A rating fails when it does not read as an integer, null included.
    """
    c = F.col(col)
    agg = df.agg(F.count_if(c.isNull()).alias("n_null"),
                 F.count_if(rating_is_malformed(c)).alias("n_malformed"))
    n_failed = F.col("n_null") + F.col("n_malformed")
    return agg.select(
        *_status_columns(CHECK_TYPE, n_failed, CODE_BAD_DATA, F.lit(MSG_TYPE_FOUND), F.lit(MSG_TYPE_NONE)),
        "n_null", "n_malformed", n_failed.alias("n_failed"))


def _status_columns(name: str, n_failed: Column, bad_code: int, bad_msg: Column, ok_msg: Column):
    ok = n_failed == 0
    return [
        F.lit(name).alias("check"),
        ok.alias("status"),
        F.when(ok, F.lit(CODE_OK)).otherwise(F.lit(bad_code)).alias("code"),
        F.when(ok, ok_msg).otherwise(bad_msg).alias("message"),
    ]


def status_report(status: Column) -> Column:
    """PASSOU / FALHOU text of a boolean status."""
    return F.when(status, F.lit(REPORT_PASSED)).otherwise(F.lit(REPORT_FAILED))


# ---------------------------------------------------------------- split
def empty_history() -> Column:
    return F.array().cast(HISTORY_ARRAY)


def history_is_empty(col: str = "historical_data") -> Column:
    """Null or empty history (``size(NULL)`` is NULL under ANSI, hence the
    explicit null test)."""
    return F.col(col).isNull() | (F.size(col) == 0)


def history_empty_normalise(df: DataFrame, col: str = "historical_data") -> DataFrame:
    """Replace a null history by a typed empty array (narrow, no shuffle)."""
    return df.withColumn(col, F.when(history_is_empty(col), empty_history()).otherwise(F.col(col)))


def history_explode(df: DataFrame, col: str = "historical_data") -> DataFrame:
    """One row per history entry (rows without history disappear)."""
    return df.select(*[c for c in df.columns if c != col], F.explode(col).alias("entry"))


def history_regroup(df: DataFrame, keys: list[str] | None = None, col: str = "historical_data") -> DataFrame:
    """Explode the history and regroup it by the silver value columns.

    Rows with the same values fuse into one with the concatenated entries;
    rows with an empty history keep a typed empty array.  Entries are sorted
    like the merge sorts them (iso_date, title, snippet, rating, app,
    segmento), so the result does not depend on shuffle order.
    """
    keys = keys or ["id", "app", "segmento", "rating", "iso_date", "title", "snippet"]
    order = ["iso_date", "title", "snippet", "rating", "app", "segmento"]
    # One pass: a row without history gives one null entry, which collect_list leaves out.
    exploded = df.select(*keys, F.explode_outer(col).alias("entry"))
    entry = F.when(F.col("entry").isNotNull(), F.struct(*[F.col(f"entry.{c}").alias(c) for c in order]))
    grouped = exploded.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_sorted"))
    return grouped.select(*keys, F.transform("_sorted", lambda e: F.struct(
        *[e[f.name].alias(f.name) for f in HISTORY_ARRAY.elementType.fields])).cast(HISTORY_ARRAY).alias(col))


def split_valid(checked: DataFrame) -> DataFrame:
    """Rows with all required columns present, in silver column order."""
    valid = checked.dropna(subset=VALID_REQUIRED)
    return history_empty_normalise(valid).select(*[f.name for f in SILVER_SCHEMA.fields])


def invalid_predicate(df: DataFrame) -> Column:
    """A critical column is null, or a row of today's batch has no segment."""
    pred = _any([F.col(c).isNull() for c in CRITICAL_COLUMNS])
    if "in_batch" in df.columns:
        pred = pred | (F.col("in_batch") & F.col("segmento").isNull())
    return pred


def split_invalid(checked: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Quarantine rows (fixed column order): rows that fail a check, and the batch rows of duplicated ids.

    With ``duplicates`` every batch row lands here once at most: a duplicated
    id comes as its batch rows only, not as its merged row as well.
    """
    pred = invalid_predicate(checked)
    if duplicates is not None and "n_batch" in checked.columns:
        pred = pred & (F.col("n_batch") <= 1)
    bad = checked.where(pred).select(*INVALID_COLUMNS)
    if duplicates is not None:
        bad = bad.unionByName(duplicates.select(*INVALID_COLUMNS))
    return bad


# ---------------------------------------------------------------- size
def size_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and UTF-8 bytes of all string columns per group: a data-based
    size estimate (partial-aggregated, no driver-side pass over rows)."""
    text_cols = [f.name for f in df.schema.fields
                 if f.dataType.simpleString() == "string" and f.name not in keys]
    nbytes = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in text_cols])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(nbytes).cast("long").alias("text_bytes"))
