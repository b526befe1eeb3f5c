"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. Each source has a weight schedule over it, given
as knots ``(t, w)`` with straight lines between them. Its integral is the
source's weight in the whole mix; all sources share the words of the corpus by
these weights, and a source never gives more than ``max_repeats`` times its own
words: what it cannot give is shared again by the others' weights (the targets
are the water level over the sources' capacities).

A source's documents stand in a seeded order, one pass after another, until its
target is used up; the document at the end is cut. The source's cumulative
demand at time t is its target times the integral of its schedule up to t. The
inverse of that function turns the place of a document's first word in the
source's passes into the time at which the training reads it, and a range sort
by this time puts the documents of all sources in training order.

Nothing passes through one task: sources are counted with map-side sums, ranks,
capacities and places come from range-sorted running sums, so a source may hold
any share of the rows. Rows are ordered by MD5 of seed and id, then by size, so
reruns and other partitionings agree.

Defined results: a null text has size 0; a null source is a source of its own,
the last; sizes of 0 are never taken and have no position; rows with equal ids
(also null ids, which count as the empty text) are documents of their own; an
empty table gives no rows; other columns are not read. Weights count in steps of
2**-20; a source of weight 0 gets nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import Tables, id_text
from firmlink.llm.running import running

#: Words are what white space (these six characters) separates.
WORD = r"[^\x20\x09-\x0D]+"
_UNITS = 1 << 20


def knots(*points: tuple[Column | float, Column | float]) -> Column:
    """A schedule: weight ``w`` at time ``t``, straight lines between the points."""
    as_double = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("double")
    return F.array(*[F.struct(as_double(t).alias("t"), as_double(w).alias("w")) for t, w in points])


def cycling_ramps(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating along the sources; every other source starts at
    half its weight and ends at one and a half, the rest run the other way."""
    w = (rank % 3 + 1).cast("double")
    tilt = F.when(rank % 2 == 0, 0.5).otherwise(-0.5)
    return knots((0.0, w * (F.lit(1.0) - tilt)), (0.5, w), (1.0, w * (F.lit(1.0) + tilt)))


def _segments(schedule: Column) -> Column:
    """Pieces ``(t0, t1, w0, w1, a0, a1)`` of a schedule; ``a`` is the integral so far."""
    n = F.size(schedule)
    step = lambda i: (schedule[i]["t"] - schedule[i - 1]["t"]) * (schedule[i]["w"] + schedule[i - 1]["w"]) / 2
    start = F.array().cast("array<struct<t0:double,t1:double,w0:double,w1:double,a0:double,a1:double>>")

    def add(done, i):
        a0 = F.coalesce(F.try_element_at(done, F.lit(-1))["a1"], F.lit(0.0))
        return F.array_append(done, F.struct(
            schedule[i - 1]["t"].alias("t0"), schedule[i]["t"].alias("t1"), schedule[i - 1]["w"].alias("w0"),
            schedule[i]["w"].alias("w1"), a0.alias("a0"), (a0 + step(i)).alias("a1")))

    return F.when(n > 1, F.aggregate(F.sequence(F.lit(1), n - 1), start, add)).otherwise(start)


def time_of(segments: Column, fraction: Column) -> Column:
    """The time at which the integral reaches ``fraction`` (0 to 1) of its end."""
    want = fraction * F.try_element_at(segments, F.lit(-1))["a1"]
    s = F.try_element_at(F.filter(segments, lambda x: x["a1"] > want), F.lit(1))
    s = F.coalesce(s, F.try_element_at(segments, F.lit(-1)))
    y, slope = want - s["a0"], (s["w1"] - s["w0"]) / (s["t1"] - s["t0"])
    root = F.sqrt(F.greatest(s["w0"] * s["w0"] + slope * y * 2, F.lit(0.0)))
    return s["t0"] + F.coalesce(F.try_divide(y * 2, s["w0"] + root), F.lit(0.0))


def source_targets(sized: DataFrame, schedule: Callable[[Column], Column], max_repeats: int, tables: Tables) -> DataFrame:
    """One row for each source of ``sized`` (source, size): ``source_size``,
    ``segments`` of its schedule, ``target`` (double) and ``take``, the target in
    whole words."""
    sources = tables.save(sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("every", F.lit(0)), "sources")
    ranked = running(sources, "every", [F.col("source").asc_nulls_last()], {"rank": ("sum", F.lit(1))}, tables)
    capped = tables.save(
        ranked.withColumn("segments", _segments(schedule(F.col("rank") - 1)))
        .withColumn("weight", F.round(F.coalesce(F.try_element_at("segments", F.lit(-1))["a1"], F.lit(0.0)) * _UNITS).cast("long"))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("level", F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight")).otherwise(float("inf"))), "weights")
    words, weights = (x or 0 for x in capped.agg(F.sum("source_size"), F.sum("weight")).first())
    filled = running(capped, "every", [F.col("level"), F.col("source").asc_nulls_last()],
                     {"cap_sum": ("sum", F.col("cap")), "weight_sum": ("sum", F.col("weight"))}, tables)
    # What is left for a source and those above it once all below it are at their capacity.
    left = F.lit(words) - (F.col("cap_sum") - F.col("cap"))
    over = F.lit(weights) - (F.col("weight_sum") - F.col("weight"))
    filled = tables.save(
        filled.withColumns({"left": left, "over": over})
        .withColumn("open", F.col("cap").cast("double") * F.col("over") > F.col("weight").cast("double") * F.col("left")), "filled")
    # Of sources on one level, the first has the largest weight over it.
    first = filled.where("open").agg(F.min(F.struct("level", -F.col("over"), F.struct("left", "over").alias("rest"))).alias("m")).first()["m"]
    if first is None:
        target = F.col("cap").cast("double")
    else:
        share = F.try_divide(F.col("weight").cast("double"), F.lit(first["rest"]["over"]).cast("double"))
        target = F.when(F.col("open"), F.least(F.lit(float(first["rest"]["left"])) * F.coalesce(share, F.lit(0.0)),
                                               F.col("cap").cast("double"))).otherwise(F.col("cap").cast("double"))
    return filled.select("source", "source_size", "segments", target.alias("target")).withColumn(
        "take", F.round("target").cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        schedule: Callable[[Column], Column] = cycling_ramps, max_repeats: int = 3, seed: int = 0) -> DataFrame:
    """One row for each document: ``id_col, source, size, source_size, target``
    (its source's share), ``take`` (the target in words), ``start`` (words of its
    source before it in a pass), ``taken`` (words the mix takes of it, repeats
    counted), ``position`` (the training time of its first word; null if nothing
    is taken) and ``segments`` (its source's schedule). ``schedule`` makes a
    source's knots from its rank, 0 for the first in code-point order."""
    tables = Tables(docs.sparkSession, "mix")
    sized = tables.save(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
        .withColumn("draw", F.md5(F.concat(F.lit(f"{seed}:"), id_text("id")))), "sizes")
    sources = source_targets(sized, schedule, max_repeats, tables).withColumnRenamed("source", "of_source")
    placed = running(sized, "source", [F.col("draw"), F.col("size")], {"end": ("sum", F.col("size"))}, tables)
    out = placed.join(sources, F.col("source").eqNullSafe(F.col("of_source"))).withColumn("start", F.col("end") - F.col("size"))
    size, whole = F.col("source_size"), F.floor(F.try_divide("take", "source_size"))
    rest = F.col("take") - whole * size
    taken = F.when(size > 0, whole * F.col("size") + F.greatest(F.least(rest - F.col("start"), F.col("size")), F.lit(0))).otherwise(0)
    out = out.withColumn("taken", taken.cast("long"))
    return out.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "take", "start", "taken",
        F.when(F.col("taken") > 0, time_of(F.col("segments"), F.try_divide("start", "take"))).alias("position"), "segments")


def by_position(mixed: DataFrame) -> DataFrame:
    """The documents range-sorted by the training time of their first word, those not taken first."""
    keys = ["position", "source", "start"]
    return mixed.repartitionByRange(*keys).sortWithinPartitions(*keys)


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each time a document is read, range-sorted: ``repeat`` (0 for
    the first pass), ``words`` (the last may be cut) and its ``position``."""
    offset = F.col("repeat") * F.col("source_size") + F.col("start")
    rows = (mixed.where("taken > 0")
            .withColumn("repeat", F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)))
            .withColumn("words", F.least("size", F.col("take") - offset))
            .withColumn("position", time_of(F.col("segments"), offset / F.col("take"))).drop("segments"))
    keys = ["position", "source", "repeat", "start"]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
