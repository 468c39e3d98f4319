"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations alone.

Every document of a source has the same expected number of copies, the
source's target over its size.  The whole part are certain copies.  The
fraction is the inclusion probability p of one more copy, drawn by Pareto
order sampling (Rosén, "On sampling with probability proportional to size",
1997): with u uniform in [0, 1), documents rank by the random odds u / (1 - u)
divided by the inclusion odds p / (1 - p), and the first ones are taken as long
as they stay within the source's remaining words.  One more document, the one
whose size comes nearest to the words still missing, closes the gap.

The cut in a source's ranking is found without sorting a source in one task:
its words are summed in bins of the rank, and only the bin that holds the cut
is looked at more closely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

#: Bins that a source's ranking is divided into, twice over.
BINS = 4096
#: Fractions below this are rounding errors of a whole number of copies.
EPSILON = 1e-9


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(id_: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the row's id, text and the seed alone."""
    key = F.concat_ws("|", F.lit(seed), F.coalesce(id_.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Adds ``target`` to (source, source_size, ...), one row a source.

    Sources in code point order, null last, have ``weights`` in turn and share
    the sum of all sizes by weight; a target stops at ``cap`` times its
    source's size, and what is over goes to the others by weight.  All targets
    are then the lesser of the cap and weight times one common level.
    """
    everything = Window.partitionBy()  # a row for each source
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn.cast("int"))).withColumn(
        "limit", F.lit(cap) * F.col("source_size") / F.col("w"))
    before = Window.orderBy("limit", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    # The first source in order of its limit whose level is within it sets the level of all.
    level = weighed.withColumn("level", left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    common = F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", "level"))).over(everything)["level"]
    target = F.least(F.lit(float(cap)) * F.col("source_size"), common * F.col("w"))
    return level.withColumn("target", target).drop("w", "limit", "level")


def _measured(df: DataFrame, id_col: str, text_col: str, source_col: str, weight: Column | None, seed: str) -> list[Column]:
    """id, source, k (the source as a key that is never null), size, u and weight of a row."""
    id_, text, source = F.col(id_col), F.col(text_col).cast("string"), F.col(source_col).cast("string")
    w = F.lit(1.0) if weight is None else F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))
    return [id_.cast("long").alias("id"), source.alias("source"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("k"),
            word_count(text).alias("size"), uniform(id_, text, seed).alias("u"), w.alias("weight")]


def _drawn(rows: DataFrame, cap: int) -> DataFrame:
    """Adds ``whole`` copies, and the rank ``r`` in [0, 1) for one more; r is null where none is due."""
    due = F.least(F.lit(float(cap)), F.when(F.col("weighed") > 0, F.col("target") * F.col("weight") / F.col("weighed")).otherwise(0.0))
    whole = F.floor(F.col("due") + EPSILON)
    p = F.col("due") - F.col("whole")
    rank = F.col("u") * (1 - p) / (F.col("u") * (1 - p) + p * (1 - F.col("u")))
    return rows.withColumn("due", due).withColumn("whole", whole).withColumn("r", F.when(p > EPSILON, rank)).drop("due")


def _cuts(drawn: DataFrame) -> DataFrame:
    """(k, cut, fit): documents of a source are taken if r < cut or r = fit."""
    b1, b2 = F.floor(F.col("r") * BINS), F.floor((F.col("r") * BINS - F.floor(F.col("r") * BINS)) * BINS)
    binned = drawn.select("k", "size", "r", b1.alias("b1"), b2.alias("b2")).filter(F.col("r").isNotNull())

    def reached(sums: DataFrame, by: str) -> DataFrame:
        """The first bin of each source at which its words reach those wanted; ``done`` are the words before it."""
        upto = F.sum("words").over(Window.partitionBy("k").orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
        return sums.withColumn("upto", F.col("done") + upto).filter(F.col("upto") >= F.col("wanted")).groupBy("k").agg(
            F.min(F.struct(by, F.expr("upto - words").alias("done"), "wanted", "words")).alias("x")).select("k", "x.*")

    totals = drawn.groupBy("k").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("wanted")).filter(F.col("wanted") > 0)
    at1 = reached(binned.groupBy("k", "b1").agg(F.sum("size").alias("words")).join(totals, "k").withColumn("done", F.lit(0)), "b1")
    at1 = materialise(at1.select("k", "b1", "done", "wanted"), "mixing-bins")
    inner = binned.join(at1, ["k", "b1"])
    at2 = reached(inner.groupBy("k", "b1", "b2", "done", "wanted").agg(F.sum("size").alias("words")), "b2")
    at2 = materialise(at2.select("k", "b2", "done", "wanted").join(at1.select("k", "b1"), "k"), "mixing-bins")
    last = reached(binned.join(at2, ["k", "b1", "b2"]).groupBy("k", "r", "done", "wanted").agg(F.sum("size").alias("words")), "r")
    # With weights the fractions may hold fewer words than wanted; then all of them are taken.
    found = totals.join(last.select("k", "r", "done"), "k", "left").select(
        "k", F.coalesce("r", F.lit(2.0)).alias("cut"), (F.col("wanted") - F.coalesce("done", F.col("wanted"))).alias("gap"))
    found = materialise(found, "mixing-cuts")
    rest = binned.join(found, "k").filter(F.col("r") >= F.col("cut")).groupBy("k", "r", "gap").agg(F.sum("size").alias("words"))
    fit = rest.withColumn("off", F.abs(F.col("gap") - F.col("words"))).filter(F.col("off") < F.col("gap")).groupBy("k").agg(F.min(F.struct("off", "r"))["r"].alias("fit"))
    return found.join(fit, "k", "left").select("k", "cut", "fit")


def mix_plan(measured: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(k, source_size, target, weighed, cut, fit), one row a source: all that decides a document's copies."""
    sizes = measured.groupBy("k", "source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("weight")).alias("weighed"))
    targets = materialise(source_targets(sizes, weights, cap).drop("source"), "mixing-targets")
    cuts = _cuts(_drawn(measured.join(targets, "k"), cap))
    return materialise(targets.join(cuts, "k", "left"), "mixing-plan")


def _with_copies(measured: DataFrame, plan: DataFrame, cap: int) -> DataFrame:
    extra = F.coalesce(F.col("r") < F.col("cut"), F.lit(False)) | F.coalesce(F.col("r") == F.col("fit"), F.lit(False))
    return _drawn(measured.join(plan, "k"), cap).withColumn("copies", (F.col("whole") + extra.cast("long")).cast("long"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[int, ...] = (1, 2, 3),
        cap: int = 3, weight: Column | None = None, seed: str = "mix") -> DataFrame:
    """One row for each document: id, source, size, source_size, target, copies and taken (size times copies).

    A document's size is its number of words.  Sources share the sum of all
    sizes by ``weights`` (see ``source_targets``).  ``weight`` favours
    documents within their source (null or negative: 0): the expected copies
    are proportional to it, up to ``cap``.  The result depends on ids, texts,
    sources and the seed alone, not on the layout of the table.

    Null or empty texts have size 0 and take nothing.  Null sources are one
    source, the last.  Null ids rank by their text.  Rows of equal id and text
    rank together and are taken together.  An empty table gives no rows.
    Other columns are not read.
    """
    measured = materialise(df.select(*_measured(df, id_col, text_col, source_col, weight, seed)), "mixing-measured")
    out = _with_copies(measured, mix_plan(measured, weights, cap), cap)
    return out.select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[int, ...] = (1, 2, 3),
          cap: int = 3, weight: Column | None = None, seed: str = "mix") -> DataFrame:
    """The rows of ``df``, each as often as ``mix`` takes it, all columns unchanged."""
    columns = _measured(df, id_col, text_col, source_col, weight, seed)
    measured = materialise(df.select(*columns), "mixing-measured")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *columns)
    out = _with_copies(rows, mix_plan(measured, weights, cap), cap).filter(F.col("copies") > 0)
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
