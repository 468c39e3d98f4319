"""A Bloom filter of one table's keys, to be applied to another table's scan.

A left outer join needs of its right side only the rows whose keys the left
side has, but an aggregation or an exchange of the right side comes before the
join can tell.  A filter of the keys' hashes tells most of it at the scan.  It
lets every row pass whose key is there, and few others, so it never changes a
join's result.

The bits are made by Spark: four places a key, OR-ed into words of 64 bits,
map-side first, and one row with all words, at most ``MOST_BITS`` / 8 bytes,
as a scalar subquery of the scan's filter.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key (about 3 % of other keys pass), places of a key, and bits at most; with more keys than they serve more other rows pass.
BITS_PER_KEY, PLACES, MOST_BITS = 8, 4, 1 << 26


def _places(key: Column, bits: int) -> list[Column]:
    a, b = F.pmod(F.xxhash64(key), F.lit(bits)), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(bits))
    return [F.pmod(a + i * b, F.lit(bits)) for i in range(PLACES)]


def key_filter(keys: DataFrame, key: str, most_bits: int = MOST_BITS) -> Callable[[Column], Column]:
    """A predicate that is true for every non-null value of ``key`` in ``keys``, and false for most others; null is false."""
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    bits = min(most_bits, 1 << max(10, math.ceil(math.log2(max(1, n) * BITS_PER_KEY))))
    at = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("p"))
    words = at.groupBy(F.expr("shiftright(p, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("b"))
    whole = keys.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("w"), "left")
    packed = whole.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0)).alias("b")))).alias("x")).select(F.transform("x", lambda x: x["b"]).alias("bits"))

    def passes(c: Column) -> Column:
        held = packed.scalar()
        one = [F.getbit(F.get(held, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in _places(c, bits)]
        out = c.isNotNull()
        for x in one:
            out = out & x
        return out

    return passes
