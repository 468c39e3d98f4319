"""Incremental history: what changed each day instead of every daily copy.

The merge needs, per id, the distinct earlier versions and the latest one.
Silver keeps a full copy of every review every day, so scanning all earlier
partitions costs O(days x reviews) and grows each day.  This store keeps
*events*: on day D an id's versions (nearly always one) became these, or the
id was gone.  ``prior`` is the partition before D, the last day on which what
stood before still stood.  An unchanged review has no event, so a day's write is
in proportion to that day's changes, deletions included.

An event's versions were last seen on the ``prior`` of the id's next event, or
on the last day covered if there is none, so the store gives the same rows as a full scan
(``history_versions``): every distinct (id, version) with its last day.  Events
after a run date are left out, so a run can be repeated for an earlier day.

    part=base-<day>    the events up to a day
    part=delta-<day>   the events of later days

A version is told from others by a digest of its values (``digest``), which its rows
carry.  Days are compared by digests alone, without reading the stored values; of a
day's texts only those of its events are exchanged, once, into their buckets.

Both lie in buckets by id, as many as the session had shuffle partitions when the
store was begun.  So the store is read, and merged with a day's reviews, without
an exchange of its own; if that day's session has as many shuffle partitions, the only exchange is that of the reviews.

When the deltas' bytes exceed ``RATIO`` of the base's they are merged into a
new base.  All of that is a published table (``tessera.sinks.publish``): each step
is one commit, whose properties list the silver partitions covered and what
their files were.  A partition that was rewritten or removed, or that arrives before
a covered one, lets the events be computed from all partitions again.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StringType, StructField, StructType
from pyspark.sql.window import Window

from tessera.operators.key_filter import key_filter
from tessera.operators.snapshot import VERSION_COLS, history_versions
from tessera.schemas import PARTITION_COLUMN
from tessera.sinks.buckets import read_buckets
from tessera.sinks.publish import State, Version, commit, current, folder_of, plain_partitions, vacuum, write_aside
from tessera.sources.history import read_history

PART = "part"
_VERSION = [StructField(c, StringType(), True) for c in VERSION_COLS]
VERSIONS_SCHEMA = StructType([StructField("id", StringType(), True), *_VERSION, StructField("odate_n", IntegerType(), True)])
#: An event's row for each version; ``gone`` rows have none.
EVENTS_SCHEMA = StructType([StructField("id", StringType(), True), *_VERSION, StructField("day", IntegerType(), True),
                            StructField("prior", IntegerType(), True), StructField("gone", BooleanType(), True), StructField("digest", BinaryType(), True)])
#: Bytes of deltas, in base bytes, above which a new base is written.
RATIO = 0.5
#: Versions of a review lie side by side and share most of their text, which a codec with a wide window finds.
CODEC = "zstd"


def compact(rows: DataFrame) -> DataFrame:
    """Distinct (id, version) rows with the last day each was seen, from silver rows."""
    return history_versions(rows)


def coverage(spark: SparkSession, silver_path: str, run_date: str) -> dict[str, str]:
    """For each silver partition before ``run_date`` what tells its files apart: the published version, else number, bytes and newest time.

    Only names and listings are read; the files' contents are not.
    """
    base = silver_path.rstrip("/")
    out = {d: x.version for d, x in current(spark, base).partitions.items() if d < run_date}
    plain = [d for d in plain_partitions(spark, base) if d not in out and d < run_date]
    if plain:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(base)
        odate = F.col(PARTITION_COLUMN).cast("string")
        found = files.groupBy(odate.alias("d")).agg(F.concat_ws(":", F.count("*"), F.sum("length"), F.max(F.unix_micros("modificationTime"))).alias("f")).where(F.col("d").isin(plain))
        out.update({r["d"]: r["f"] for r in found.collect()})  # a row a day
    return out


def digest() -> Column:
    """SHA-256 of a version's values, each with its length, nulls told from any text."""
    values = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in VERSION_COLS]
    return F.unhex(F.sha2(F.concat(*values), 256))


def changes(keys: DataFrame, days: list[int], known: int | None = None) -> DataFrame:
    """Events, without the versions' values, of the rows (id, ``odate_n``, digest) over the covered ``days``.

    ``known`` is a day that stands for what the store holds already: its rows
    are compared with, but give no events of their own.
    """
    near = keys.sparkSession.createDataFrame([(d, a, b) for a, d, b in zip([None, *days], days, [*days[1:], None])], "odate_n int, prior int, next int")
    sets = keys.where(F.col("id").isNotNull()).groupBy("id", "odate_n").agg(F.array_sort(F.collect_set("digest")).alias("versions")).join(near, "odate_n")
    w = Window.partitionBy("id").orderBy("odate_n")
    same = (F.lag("odate_n").over(w) == F.col("prior")) & F.lag("versions").over(w).eqNullSafe(F.col("versions"))
    seen = sets.withColumns({"same": F.coalesce(same, F.lit(False)), "left": F.col("next").isNotNull() & ~F.lead("odate_n").over(w).eqNullSafe(F.col("next"))})
    set_here = F.transform("versions", lambda v: F.struct(F.col("odate_n").alias("day"), F.col("prior").alias("prior"), F.lit(False).alias("gone"), v.alias("digest")))
    gone_next = F.struct(F.col("next").alias("day"), F.col("odate_n").alias("prior"), F.lit(True).alias("gone"), F.lit(None).cast("binary").alias("digest"))
    kind = ArrayType(StructType([f for f in EVENTS_SCHEMA.fields if f.name in ("day", "prior", "gone", "digest")]))
    none = F.array().cast(kind)
    made = F.concat(F.when(F.col("same"), none).otherwise(set_here.cast(kind)), F.when(F.col("left"), F.array(gone_next).cast(kind)).otherwise(none))
    out = seen.select("id", F.explode(made).alias("e")).select("id", "e.*")
    return out if known is None else out.where(F.col("day") > known)


def with_values(found: DataFrame, rows: DataFrame, buckets: int, few: bool = True) -> DataFrame:
    """The events ``found`` with their versions' values out of ``rows``, dealt to ``buckets`` by id.

    With ``few`` a Bloom filter of the events' ids and days keeps most other rows from the exchange.
    """
    values = rows.where(F.col("id").isNotNull())
    if few:
        day_of = found.where(~F.col("gone")).select(F.xxhash64("id", "day").alias("key"))
        values = values.where(key_filter(day_of, "key")(F.xxhash64("id", "odate_n")))
    values = values.select("id", *VERSION_COLS, "odate_n", digest().alias("digest"))
    gone = found.where("gone").select("id", *[F.lit(None).cast("string").alias(c) for c in VERSION_COLS], F.col("day").alias("odate_n"), "digest")
    dealt = values.unionByName(gone).repartition(buckets, "id").distinct()  # a version may have several rows on a day
    of_id = found.repartition(buckets, "id").groupBy("id").agg(F.collect_list(F.struct("day", "prior", "gone", "digest")).alias("events"))
    mine = F.filter("events", lambda e: (e["day"] == F.col("odate_n")) & e["digest"].eqNullSafe(F.col("digest")))
    made = dealt.join(of_id, "id").select("id", *VERSION_COLS, F.explode(mine).alias("e"))
    return made.select("id", *VERSION_COLS, "e.day", "e.prior", "e.gone", "e.digest")


def events(rows: DataFrame, days: list[int], known: int | None = None) -> DataFrame:
    """Events of the rows (id, version columns, ``odate_n``) over the covered ``days``; see ``changes``."""
    found = changes(rows.select("id", "odate_n", digest().alias("digest")), days, known)
    return with_values(found, rows, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def standing(stored: DataFrame, day: int) -> DataFrame:
    """The rows (id, ``odate_n`` = ``day``, digest) that stand after the last event of each id."""
    last = F.max("day").over(Window.partitionBy("id"))
    return stored.select("id", "day", "gone", "digest").withColumn("last", last).where((F.col("day") == F.col("last")) & ~F.col("gone")).select("id", F.lit(day).alias("odate_n"), "digest")


def versions_of(stored: DataFrame, last_day: int) -> DataFrame:
    """Distinct (id, version) rows with the last day each was seen; partitioned by id, so that a grouping by id needs no further exchange."""
    later = Window.partitionBy("id").orderBy("day").rangeBetween(1, Window.unboundedFollowing)
    until = F.coalesce(F.first("prior").over(later), F.lit(last_day))
    return stored.withColumn("until", until).where(~F.col("gone")).groupBy("id", *VERSION_COLS).agg(F.max("until").alias("odate_n"))


def stored_events(spark: SparkSession, versions_path: str) -> DataFrame:
    """All events, partitioned by id as their buckets are.

    A union of bare Parquet scans is made of columnar batches, for which Spark 4.1
    plans with the buckets' partitioning but lays the parts' partitions side by side,
    so that an id's events would not meet; the filter, true for every event, makes it one of rows.
    """
    state = current(spark, versions_path)
    parts = [read_buckets(spark, folder_of(versions_path, PART, value, x.version), EVENTS_SCHEMA, x.buckets, "id").where("day IS NOT NULL")
             for value, x in sorted(state.partitions.items())]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], EVENTS_SCHEMA)


def _buckets(spark: SparkSession, versions_path: str) -> int:
    return current(spark, versions_path).properties.get("buckets") or int(spark.conf.get("spark.sql.shuffle.partitions"))


def _write(spark: SparkSession, versions_path: str, rows: DataFrame, part: str) -> Version:
    return write_aside(rows.select(*EVENTS_SCHEMA.fieldNames()), versions_path, part, PART, CODEC, _buckets(spark, versions_path), by="id")


def _write_events(spark: SparkSession, versions_path: str, silver: DataFrame, days: list[int], part: str, last: int | None = None) -> Version:
    """The events of the silver rows over ``days``, compared with what the store holds of its ``last`` day, as a version of a part."""
    rows = silver.select("id", *VERSION_COLS, F.col(PARTITION_COLUMN).try_cast("int").alias("odate_n"))
    keys = rows.select("id", "odate_n", digest().alias("digest"))
    if last is not None:
        keys = keys.unionByName(standing(stored_events(spark, versions_path), last))
        days = [last, *days]
    found = changes(keys, days, last).persist(StorageLevel.MEMORY_AND_DISK)  # ids and digests; read for the filter and the join
    try:
        return _write(spark, versions_path, with_values(found, rows, _buckets(spark, versions_path), few=len(days) > 1), part)
    finally:
        found.unpersist()


def _rewrite(spark: SparkSession, versions_path: str, made: Version, day: str, covered: dict[str, str]) -> None:
    """A new base in place of all parts."""

    def change(state: State) -> None:
        state.partitions = {f"base-{day}": made}
        state.properties = {"covered": covered, "buckets": made.buckets, "digests": True}

    commit(spark, versions_path, change)
    vacuum(spark, versions_path, PART)


def update(spark: SparkSession, versions_path: str, silver_path: str, run_date: str) -> int:
    """Bring the store up to the silver partitions before ``run_date``; the number of event rows written."""
    now = coverage(spark, silver_path, run_date)
    state = current(spark, versions_path)
    held: dict[str, str] = state.properties.get("covered", {})
    added = sorted(set(now) - set(held))
    silver = read_history(spark, silver_path, run_date)
    stale = any(now.get(d) != f for d, f in held.items() if d < run_date) or (held and added and added[0] < max(held))
    if stale or (held and not state.properties.get("digests")):  # a store without digests was written by an earlier release
        # Days from the run date on stay covered no longer: their events are computed again when their turn comes.
        made = _write_events(spark, versions_path, silver, [int(d) for d in sorted(now)], f"base-{run_date}")
        _rewrite(spark, versions_path, made, run_date, now)
        return made.rows
    if not added:
        return 0
    last = int(max(held)) if held else None
    part = f"delta-{added[-1]}" if held else f"base-{added[-1]}"
    made = _write_events(spark, versions_path, silver.where(F.col(PARTITION_COLUMN).isin(added)), [int(d) for d in added], part, last)

    def change(state: State) -> None:
        state.partitions[part] = made
        state.properties = {"covered": {**held, **{d: now[d] for d in added}}, "buckets": made.buckets, "digests": True}

    state = commit(spark, versions_path, change)
    vacuum(spark, versions_path, PART)
    base = sum(x.bytes for k, x in state.partitions.items() if k.startswith("base-"))
    if sum(x.bytes for k, x in state.partitions.items() if k.startswith("delta-")) > RATIO * base:
        whole = _write(spark, versions_path, stored_events(spark, versions_path), f"base-{added[-1]}")
        _rewrite(spark, versions_path, whole, added[-1], state.properties["covered"])
    return made.rows


def prepare_versions(spark: SparkSession, versions_path: str, silver_path: str, run_date: str) -> DataFrame:
    """History versions for a run on ``run_date``, from the store brought up to date first."""
    update(spark, versions_path, silver_path, run_date)
    covered = [d for d in current(spark, versions_path).properties.get("covered", {}) if d < run_date]
    if not covered:
        return spark.createDataFrame([], VERSIONS_SCHEMA)
    stored = stored_events(spark, versions_path).where(F.col("day") < int(run_date))
    return versions_of(stored, int(max(covered))).select(*VERSIONS_SCHEMA.fieldNames())
