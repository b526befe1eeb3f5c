"""Keep-first, pick-best and insert-if-absent.

All three are arg-min aggregations: ``min(struct(order..., row))`` grouped by
the key. Spark aggregates that partially on the map side before the shuffle,
so a hot key (even a third of all rows) reaches the reducer as one row per
map task instead of being sorted in one task, as a ``row_number`` window
would. Order columns compare ascending with NULLs first; pass negated
numbers for descending order. The row payload is the final tie-break, so the
survivor is deterministic under any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cs: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _arg_min(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    order_cols = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))]
    best = F.min(F.struct(*order_cols, F.struct(*payload).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*").select(*df.columns)


def _null_key(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """True for rows with a NULL in a key; None when no key can be NULL."""
    loose = [k for k in keys if df.schema[k].nullable]
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in loose]) if loose else None


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in ``order_by`` order (ON CONFLICT DO NOTHING within a
    batch). Rows with a NULL in any key never conflict: all are kept. The input
    is read once: rows with a NULL key get a number of their own as one more
    grouping key."""
    keys = list(keys)
    null_key = _null_key(df, keys)
    if null_key is None:
        return _arg_min(df, keys, order_by)
    own = F.when(null_key, F.monotonically_increasing_id())
    order = {f"_k{i}": c for i, c in enumerate(_cols(order_by))}
    marked = df.select("*", own.alias("_own"), *[c.alias(n) for n, c in order.items()])
    return _arg_min(marked, [*keys, "_own"], list(order)).select(*df.columns)


def pick_best(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per key (NULL keys form one group), the smallest in
    ``order_by`` order."""
    return _arg_min(df, list(keys), order_by)


def insert_if_absent(
    new: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    nulls_equal: bool = False,
) -> DataFrame:
    """Rows of ``new`` that an INSERT ... ON CONFLICT (keys) DO NOTHING would
    add to ``target``: absent from the target, first per key within the batch.
    Keys already present are dropped before the batch is reduced.

    NULL keys never conflict and are always inserted; with ``nulls_equal`` a
    NULL equals a NULL, as in the unified table, which holds one row for each
    ``(abn, domain)``. Then applying the result and running again inserts
    nothing."""
    keys = list(keys)
    existing = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    pairs = [(F.col(k), F.col(f"_t_{k}")) for k in keys]
    same = reduce(lambda a, b: a & b, [a.eqNullSafe(b) if nulls_equal else a == b for a, b in pairs])
    fresh = new.join(existing, same, "left_anti")
    return (pick_best if nulls_equal else keep_first)(fresh, keys, order_by).select(*new.columns)
