"""Partitions that are replaced at once: written aside, then committed by one record.

A table of this kind has two hidden folders beside any plain partitions:

    _data/<column>=<value>/version=<id>/   the files of one write, never changed afterwards
    _log/<number>.json                     the table after a commit: the version of every partition

A write fills a folder of its own and then adds the next record, which names
for each partition the version that counts.  Readers take the newest whole
record and read the folders it names, so they see a table as some commit left
it: a write that fails leaves files that no record names, and a reader that began
before a commit keeps its files.  A record appears whole and carries its own
digest; one that does not match it does not count.  Two writers that commit
together want the same number; the file system lets one of them have it, the
other reads the new state and tries the next.

A plain partition ``<column>=<value>/`` of the same folder, as other writers
leave them, belongs to the table until a commit names that value.
"""

from __future__ import annotations

import hashlib
import json
import logging
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.schemas import PARTITION_COLUMN
from tessera.session import shuffles_removed
from tessera.sinks.buckets import write_buckets
from tessera.sinks.files import create_text, file_sizes, listing, modified, read_text, remove
from tessera.sinks.parquet import conform

log = logging.getLogger(__name__)

DATA, LOG = "_data", "_log"
#: Records kept, and so the states whose files stay readable.
KEEP_STATES = 3
#: Age in seconds after which files that no kept record names are taken for those of a failed write.
ABANDONED_S = 24 * 3600


@dataclass(frozen=True)
class Version:
    """One partition's files; ``buckets`` is 0 for files that are not in buckets."""
    version: str
    rows: int
    files: int
    bytes: int
    buckets: int = 0


@dataclass
class State:
    """A table after a commit; ``properties`` are the table owner's own, ``seen`` is the last record that there was."""
    number: int = 0
    seen: int = 0
    partitions: dict[str, Version] = field(default_factory=dict)
    properties: dict = field(default_factory=dict)


def _record(state: State) -> str:
    body = json.dumps({"partitions": {k: vars(v) for k, v in sorted(state.partitions.items())}, "properties": state.properties}, sort_keys=True)
    return f"{hashlib.sha256(body.encode()).hexdigest()}\n{body}\n"


def _parsed(number: int, text: str | None, seen: int = 0) -> State | None:
    digest, _, body = (text or "").partition("\n")
    body = body.rstrip("\n")
    if hashlib.sha256(body.encode()).hexdigest() != digest:
        return None
    fields = json.loads(body)
    return State(number, seen, {k: Version(**v) for k, v in fields["partitions"].items()}, fields["properties"])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(m.group(1)) for m in (re.fullmatch(r"(\d+)\.json", n) for n in listing(spark, f"{path}/{LOG}")) if m)


def current(spark: SparkSession, path: str) -> State:
    """The table as the newest whole record has it; an empty state without one."""
    base = path.rstrip("/")
    while True:
        numbers = _numbers(spark, base)
        for number in reversed(numbers):
            state = _parsed(number, read_text(spark, f"{base}/{LOG}/{number:012d}.json"), numbers[-1])
            if state is not None:
                return state
        if numbers == _numbers(spark, base):  # else the records seen were removed meanwhile, and newer ones are there
            return State(seen=max(numbers, default=0))


def commit(spark: SparkSession, path: str, change: Callable[[State], None]) -> State:
    """Apply ``change`` to the newest state and record it; applied anew if another writer was first."""
    base = path.rstrip("/")
    while True:
        state = current(spark, base)
        change(state)
        state.number = state.seen + 1
        if create_text(spark, f"{base}/{LOG}/{state.number:012d}.json", _record(state)):
            return state


def folder_of(path: str, column: str, value: str, version: str) -> str:
    return f"{path.rstrip('/')}/{DATA}/{column}={value}/version={version}"


def write_aside(df: DataFrame, path: str, value: str, column: str = PARTITION_COLUMN, compression: str = "snappy", buckets: int = 0, by: str | None = None) -> Version:
    """The rows as a version that no record names yet, in ``buckets`` by the column ``by`` if that is given.

    Rows are counted in the written files' footers.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", value):
        raise ValueError(f"partition value {value!r} must be of letters, digits and . _ -")
    version = f"v{uuid.uuid4().hex}"
    folder = folder_of(path, column, value, version)
    with shuffles_removed(df.sparkSession):
        if buckets and by:
            write_buckets(df, folder, buckets, by, compression)
        else:
            df.write.option("compression", compression).parquet(folder)
        rows = df.sparkSession.read.schema(df.schema).parquet(folder).count()
    sizes = file_sizes(df.sparkSession, folder)
    return Version(version, rows, len(sizes), sum(sizes), buckets if by else 0)


def publish(df: DataFrame, path: str, value: str, label: str = "data", schema: StructType | None = None, column: str = PARTITION_COLUMN,
            compression: str = "snappy") -> int:
    """Replace one partition by the rows of ``df``, an empty frame by none; the number of rows.

    Nothing changes for readers until every file is written.  Errors are raised.
    """
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    if not path:
        raise ValueError("destination path must not be empty")
    df = conform(df, schema) if schema is not None else df
    df = df.drop(column) if column in df.columns else df
    made = write_aside(df, path, value, column, compression)
    commit(df.sparkSession, path, lambda state: state.partitions.update({value: made}))
    vacuum(df.sparkSession, path, column)
    log.info("published %d %s rows as %s=%s of %s", made.rows, label, column, value, path)
    return made.rows


def vacuum(spark: SparkSession, path: str, column: str = PARTITION_COLUMN, keep: int = KEEP_STATES, abandoned_s: int = ABANDONED_S) -> None:
    """Remove the records before the newest ``keep``, and the files that no kept record names.

    Files younger than ``abandoned_s`` seconds that no record at all has named may belong to
    a write under way, so they stay.
    """
    base = path.rstrip("/")
    numbers = _numbers(spark, base)
    if len(numbers) <= keep:
        return
    states = {n: _parsed(n, read_text(spark, f"{base}/{LOG}/{n:012d}.json")) for n in numbers}
    named = {(v, x.version) for n in numbers[-keep:] if states[n] for v, x in states[n].partitions.items()}
    replaced = {(v, x.version) for n in numbers[:-keep] if states[n] for v, x in states[n].partitions.items()} - named
    for n in numbers[:-keep]:
        remove(spark, f"{base}/{LOG}/{n:012d}.json")
    for value, version in replaced:
        remove(spark, folder_of(base, column, value, version))
    oldest = (time.time() - abandoned_s) * 1000
    for value in {v for v, _ in replaced}:
        for name in listing(spark, f"{base}/{DATA}/{column}={value}"):
            folder = f"{base}/{DATA}/{column}={value}/{name}"
            if (value, name.removeprefix("version=")) not in named and modified(spark, folder) < oldest:
                remove(spark, folder)


def plain_partitions(spark: SparkSession, path: str, column: str = PARTITION_COLUMN) -> list[str]:
    """Values of the partitions that lie in the table's folder itself."""
    return [n.split("=", 1)[1] for n in listing(spark, path) if n.startswith(f"{column}=")]


def read_table(spark: SparkSession, path: str, schema: StructType, column: str = PARTITION_COLUMN, before: str | None = None) -> DataFrame | None:
    """The table with its partition column as a string, only the partitions below ``before`` if it is given; None if there is no such table.

    Published partitions are those of the newest commit at the time of the call.
    """
    base = path.rstrip("/")
    full = StructType([f for f in schema.fields if f.name != column] + [StructField(column, StringType(), True)])
    state = current(spark, base)
    plain = plain_partitions(spark, base, column)
    if not state.number and not plain:
        return None
    frames = []
    folders = [folder_of(base, column, value, x.version) for value, x in sorted(state.partitions.items()) if before is None or value < before]
    if folders:
        frames.append(spark.read.schema(full).option("basePath", f"{base}/{DATA}").parquet(*folders).select(*full.fieldNames()))
    if plain:
        rest = spark.read.schema(full).parquet(base)
        if state.partitions.keys() & set(plain):
            rest = rest.where(~F.col(column).isin(sorted(state.partitions.keys() & set(plain))))
        frames.append(rest.where(F.col(column) < F.lit(before)) if before is not None else rest)
    if not frames:
        return spark.createDataFrame([], full)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
