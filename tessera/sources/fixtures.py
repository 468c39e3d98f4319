"""Review-shaped frames derived from the ``documents`` table.

The job works on app-store reviews; the test data has documents.  These
deterministic column rules turn *every* document into review rows (each
document lands in the incoming batch, in the history, or in both), so the
queries scale with the table.  The same rules are written in DuckDB SQL in
``tessera.oracle`` and must stay in step with this file.

bronze  documents with doc_id % 7 <> 3 (dup = 0), plus a second copy (dup = 1)
        of those with doc_id % 29 = 4, which is the later duplicate.
hist    documents with doc_id % 13 <> 5 or doc_id % 7 = 3, two days v = 1, 2.

The two filters make ids that only one side of a merge has.  Queries on one
side alone pass ``every=True`` and read all documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.normalize import normalize_reviews
from tessera.functions.text import fold_upper
from tessera.sources.spread import spread

RUN_DATE = "20240103"
HISTORY_DATES = ("20240101", "20240102")
#: Codec of the bronze layout and of the store's days, which hold every text up to ten times; the history table is written as the job writes it.
CODEC = "zstd"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(doc_id: Column) -> Column:
    return F.lpad((F.lit(1) + doc_id % 28).cast("string"), 2, "0")


def _title(source: Column) -> Column:
    # The reviewer's display name.
    return F.concat(F.lit("Usuário "), source)


def bronze(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """Raw reviews: avatar, date, id, iso_date, likes, rating, snippet, title,
    app, segmento (app/segmento as if already derived from the path)."""
    return bronze_with_doc(spark, sf_dir, every).drop("doc_id")


def bronze_with_doc(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """``bronze`` plus the source ``doc_id``."""
    d = documents(spark, sf_dir)
    if not every:
        d = d.where(F.col("doc_id") % 7 != 3)
    copies = F.when(F.col("doc_id") % 29 == 4, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    b = d.select("*", F.explode(copies).alias("dup"))  # one scan; dup = 1 is the later copy
    doc_id = F.col("doc_id")
    id_col = F.when(doc_id % 97 == 0, F.lit(None).cast("string")).otherwise(doc_id.cast("string"))
    return b.select(
        F.concat(F.lit("avatar"), id_col).alias("avatar"),
        F.concat(F.lit("2024-02-"), _day(doc_id)).alias("date"),
        id_col.alias("id"),
        F.concat(F.lit("2024-02-"), _day(doc_id),
                 F.when(F.col("dup") == 1, F.lit("T12:00:00Z")).otherwise(F.lit("T00:00:00Z"))).alias("iso_date"),
        (doc_id % 300).alias("likes"),
        F.when(doc_id % 23 == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(1) + (doc_id + F.col("dup")) % 5).cast("double") + F.lit(0.75)).alias("rating"),
        F.col("text").alias("snippet"),
        F.when(doc_id % 17 == 0, F.lit(None).cast("string")).otherwise(_title(F.col("source"))).alias("title"),
        F.col("source").alias("app"),
        F.when(doc_id % 41 == 0, F.lit(None).cast("string"))
         .when(doc_id % 2 == 0, F.lit("pf")).otherwise(F.lit("pj")).alias("segmento"),
        doc_id,
    )


def norm(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """Normalised incoming batch."""
    return normalize_reviews(bronze(spark, sf_dir, every))


def hist(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """Earlier silver rows on two days (odate 20240101, 20240102)."""
    d = documents(spark, sf_dir)
    if not every:
        d = d.where((F.col("doc_id") % 13 != 5) | (F.col("doc_id") % 7 == 3))
    # fold once per document, then fan out to the two days
    d = d.select("doc_id", "source", fold_upper(_title(F.col("source"))).alias("ftitle"),
                 fold_upper(F.col("text")).alias("ftext"))
    d = d.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("v"))
    doc_id, v = F.col("doc_id"), F.col("v")
    return d.select(
        doc_id.cast("string").alias("id"),
        F.col("source").alias("app"),
        F.when(doc_id % 2 == 0, F.lit("pf")).otherwise(F.lit("pj")).alias("segmento"),
        (F.lit(1) + (doc_id + F.when(doc_id % 5 == v, 1).otherwise(0)) % 5).cast("string").alias("rating"),
        F.concat(F.lit("2024-02-"), _day(doc_id),
                 F.when(doc_id % 11 == v, F.lit("T06:00:00Z")).otherwise(F.lit("T00:00:00Z"))).alias("iso_date"),
        F.concat(F.when(doc_id % 3 == v, F.lit("OLD ")).otherwise(F.lit("")), F.col("ftitle")).alias("title"),
        F.concat(F.when(doc_id % 19 == v, F.lit("X ")).otherwise(F.lit("")), F.col("ftext")).alias("snippet"),
        F.concat(F.lit("2024010"), v.cast("string")).alias("odate"),
    )


#: Ten days of one table; a few reviews change, go or come back each day.
TEN_DAYS = tuple(f"202402{k:02d}" for k in range(1, 11))


def ten_days(spark: SparkSession, sf_dir: str, days: tuple[str, ...] = TEN_DAYS) -> DataFrame:
    """Every document as a review on each of ten days, or on some of them: its rating changes every seventh day, its app on two
    days only (and back), it is missing on some day, and some have two rows on even days."""
    doc_id, k = F.col("doc_id"), F.col("k")
    d = documents(spark, sf_dir).select("doc_id", "source", "text", F.explode(F.array(*[F.lit(TEN_DAYS.index(x) + 1) for x in days])).alias("k"))
    d = d.where((doc_id + k) % 17 != 0)
    copies = F.when((doc_id % 29 == 4) & (k % 2 == 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = d.select("*", F.explode(copies).alias("dup"))
    return d.select(
        doc_id.cast("string").alias("id"),
        F.when((doc_id % 13 == 0) & k.isin(4, 5), F.concat(F.lit("X "), "source")).otherwise(F.col("source")).alias("app"),
        F.lit("pf").alias("segmento"),
        (F.lit(1) + F.floor((doc_id + k) / 7) % 5).cast("string").alias("rating"),
        F.when(F.col("dup") == 1, F.lit("2024-02-01T12:00:00Z")).otherwise(F.lit("2024-02-01T00:00:00Z")).alias("iso_date"),
        F.col("source").alias("title"), F.col("text").alias("snippet"), F.format_string("202402%02d", "k").alias("odate"))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings as delivered text: numeric, 'n/a' or null."""
    doc_id = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc_id.cast("string").alias("id"),
        F.when(doc_id % 31 == 0, F.lit("n/a"))
         .when(doc_id % 23 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat((F.lit(1) + doc_id % 5).cast("string"), F.lit(".75"))).alias("rating_raw"),
    )


def bronze_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File paths in the bronze layout, including non-matching ones."""
    doc_id = F.col("doc_id")
    app = F.when(doc_id % 3 == 0, F.lit("my_app")).otherwise(F.col("source"))
    seg = F.when(doc_id % 2 == 0, F.lit("_pf")).otherwise(F.lit("_pj"))
    tail = F.when(doc_id % 5 == 0, F.lit("/dt=1")).otherwise(F.lit("/odate=20240101/p"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("/x/googlePlay/"), app, seg, tail).alias("path"))


# ------------------------------------------------------------ written layouts
# Bronze folders: <app>_<segment>/odate=<run date>/.  Three apps, one of them
# with an underscore in its name (its segment does not parse from the path).
LAYOUT_APPS = ("my_app", "appone", "apptwo")
LAYOUT_SEGMENTS = ("pf", "pj")
RAW_COLUMNS = ["avatar", "date", "id", "iso_date", "likes", "rating", "snippet", "title"]


def layout_app(doc_id: Column) -> Column:
    return (F.when(doc_id % 3 == 0, F.lit(LAYOUT_APPS[0]))
             .when(doc_id % 3 == 1, F.lit(LAYOUT_APPS[1])).otherwise(F.lit(LAYOUT_APPS[2])))


def layout_segment(doc_id: Column) -> Column:
    return F.when(doc_id % 2 == 0, F.lit("pf")).otherwise(F.lit("pj"))


def write_bronze_layout(spark: SparkSession, sf_dir: str, bronze_base: str, run_date: str = RUN_DATE,
                        extra_dates: tuple[str, ...] = (), every: bool = False,
                        shape: Callable[[str, str, DataFrame], DataFrame] | None = None) -> None:
    """Write the bronze fixture as raw files in the collector's folder layout.

    The folder set is fixed by rule (3 apps x 2 segments), so no distinct
    values are collected; ``response`` is not written and reads back as null.
    One write per folder covers every date (``partitionBy("odate")`` with
    dynamic overwrite, so other dates already there are kept).  ``shape`` may
    change the columns of a folder, given its app and segment.
    """
    dates = (run_date, *extra_dates)
    raw = bronze_with_doc(spark, sf_dir, every).select(
        *RAW_COLUMNS, layout_app(F.col("doc_id")).alias("_app"), layout_segment(F.col("doc_id")).alias("_seg"),
        F.explode(F.array(*[F.lit(d) for d in dates])).alias("odate"))
    base = bronze_base.rstrip("/")  # each folder scans the documents for itself: all their texts are too much to persist
    for app in LAYOUT_APPS:
        for seg in LAYOUT_SEGMENTS:
            part = raw.where((F.col("_app") == app) & (F.col("_seg") == seg)).select(*RAW_COLUMNS, "odate")
            part = shape(app, seg, part) if shape else part
            (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
                 .partitionBy("odate").parquet(f"{base}/{app}_{seg}"))


def write_drifting_layout(spark: SparkSession, sf_dir: str, bronze_base: str) -> None:
    """The bronze layout as a collector with faults leaves it: ratings as text in one segment, as whole
    numbers and without ``likes`` in one app, text files where Parquet should be, and a response of another type."""
    def shape(app: str, seg: str, df: DataFrame) -> DataFrame:
        if app == "apptwo":
            return df.withColumns({"rating": F.col("rating").cast("int"), "response": F.lit("none")}).drop("likes")
        return df.withColumn("rating", F.col("rating").cast("string")) if seg == "pj" else df

    write_bronze_layout(spark, sf_dir, bronze_base, every=True, shape=shape)
    for app in LAYOUT_APPS[:2]:
        documents(spark, sf_dir).where("doc_id < 3").select(F.substring("text", 1, 50)).coalesce(1).write.mode("append").text(f"{bronze_base.rstrip('/')}/{app}_pf/odate={RUN_DATE}")


def write_history_table(spark: SparkSession, sf_dir: str, silver_path: str,
                        late_copy_date: str | None = RUN_DATE, every: bool = False) -> None:
    """Write ``hist`` as silver partitions (odate=20240101, 20240102).

    With ``late_copy_date`` the second day is also written under that date,
    a partition the history cut-off must exclude.
    """
    from tessera.operators.quality import empty_history
    from tessera.schemas import SILVER_SCHEMA
    h = hist(spark, sf_dir, every)
    if late_copy_date:
        h = h.unionByName(h.where(F.col("odate") == HISTORY_DATES[1]).withColumn("odate", F.lit(late_copy_date)))
    cols = [f.name for f in SILVER_SCHEMA.fields if f.name != "historical_data"]
    (h.select(*cols, empty_history().alias("historical_data"), "odate")
      .write.mode("overwrite").partitionBy("odate").parquet(silver_path))
