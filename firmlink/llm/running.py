"""Running sums inside groups of any size.

A window over ``PARTITION BY group`` sends a whole group through one task. Here
the rows are range-sorted by group and order, so a hot group spans as many tasks
as its rows need; each task's part is summed on its own, and the few groups that
cross a border between tasks get the sum of their earlier parts added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlink.llm.common import Tables, free_name


def running(df: DataFrame, group: str, order: list[Column], adds: dict[str, tuple[str, Column]],
            tables: Tables) -> DataFrame:
    """``df`` with one inclusive running aggregate of longs for each entry of
    ``adds`` (``name: ("sum" | "xor", column)``), within ``group`` (null is a
    group of its own) along ``order``. Rows that tie in ``order`` are placed
    arbitrarily among themselves, so ``order`` should tell all rows apart that
    differ in what the caller returns.

    ``df`` is read twice (range sampling): pass a stored table. What is
    broadcast holds at most two rows for each task of the range sort. An empty
    ``df`` gives an empty result."""
    part, edge, g = free_name(df, "part"), free_name(df, "edge"), F.col(group)
    total = {"sum": F.sum, "xor": F.bit_xor}
    plus = {"sum": lambda a, b: a + b, "xor": lambda a, b: a.bitwiseXOR(b)}
    own = {n: free_name(df, f"own_{n}") for n in adds}
    here = {n: free_name(df, f"here_{n}") for n in adds}
    carried = {n: free_name(df, f"carry_{n}") for n in adds}
    dealt = tables.save(
        df.withColumns({own[n]: c for n, (_, c) in adds.items()})
        .repartitionByRange(g.asc_nulls_last(), *order).withColumn(part, F.spark_partition_id()), "ranges")
    # A group that goes on in a later part is the last group of an earlier one.
    last = dealt.groupBy(part).agg(F.max(F.struct(g.isNull().alias("no"), g.alias(edge))).alias("m")).select(f"m.{edge}").distinct()
    crossing = (dealt.join(F.broadcast(last), F.col(edge).eqNullSafe(g)).groupBy(edge, part)
                .agg(*[total[kind](own[n]).alias(own[n]) for n, (kind, _) in adds.items()]))
    before = Window.partitionBy(edge).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    of_part = free_name(df, "of_part")
    carry = crossing.select(edge, F.col(part).alias(of_part), *[
        F.coalesce(total[kind](own[n]).over(before), F.lit(0)).alias(carried[n]) for n, (kind, _) in adds.items()])
    inside = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({here[n]: total[kind](own[n]).over(inside) for n, (kind, _) in adds.items()})
    out = local.join(F.broadcast(carry), F.col(edge).eqNullSafe(g) & (F.col(of_part) == F.col(part)), "left")
    return out.select(*df.columns, *[
        plus[kind](F.col(here[n]), F.coalesce(F.col(carried[n]), F.lit(0))).alias(n) for n, (kind, _) in adds.items()])
