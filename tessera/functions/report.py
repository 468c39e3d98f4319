"""Key/value report parsing as DataFrame expressions.

A report is a multi-line string of ``key => value`` or ``key = value``
lines.  A line is kept when, after stripping, it is non-empty, does not start
with ``Scheduling mode`` and splits into exactly two parts; within one report
a later line wins for a repeated key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: separators and skipped header of the report format
KV_SEPARATOR = r" => | = "
SKIPPED_PREFIX = "Scheduling mode"

# --- fixed values: the white space that Python's ``str.strip()`` removes, as a character class
_SPACE = "[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
_STRIP = f"^{_SPACE}+|{_SPACE}+$"


def strip(c: Column) -> Column:
    """Python-style ``str.strip()``: surrounding white space, Unicode's too."""
    return F.regexp_replace(c, _STRIP, "")


def report_lines(df: DataFrame, report_col: str, keys: list[str]) -> DataFrame:
    """One row per line: ``keys + [line_no, line]`` (line_no from 0)."""
    return df.select(*keys, F.posexplode(F.split(strip(F.col(report_col)), "\n")).alias("line_no", "line"))


def parse_kv_lines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Parse the output of :func:`report_lines` into ``keys + [key, value]``.

    The per-report "last line wins" rule is a ``max_by`` per (report, key),
    i.e. one partial-aggregated shuffle on the report keys.
    """
    parsed = (
        lines
        .where(~F.col("line").startswith(SKIPPED_PREFIX))
        # An empty line splits into one part, so the size decides for it, too.
        .select(*keys, "line_no", F.split(strip(F.col("line")), KV_SEPARATOR).alias("parts"))
        .where(F.size("parts") == 2)
        .select(*keys, "line_no",
                strip(F.get("parts", 0)).alias("key"),
                strip(F.get("parts", 1)).alias("value"))
    )
    return (parsed.groupBy(*keys, "key")
            .agg(F.max_by("value", "line_no").alias("value")))
