"""Projection that is evaluated once.

Catalyst pushes filters below projections by substituting the projected
expressions into the filter condition. For costly expressions (XML parsing,
regex chains) that evaluates them twice per row, or several times when the
filter references several columns of one parsed struct, and can make one
generated method exceed the JVM's 64 KB limit. A ``Generate`` node
(``inline(array(struct(..)))``) is a boundary filters on generated columns
cannot cross, so the expressions are computed once, in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_once(df: DataFrame, keep: list[str], exprs: dict[str, Column]) -> DataFrame:
    """``df.select(*keep, *[e.alias(n) for n, e in exprs.items()])`` with the
    ``exprs`` computed exactly once per row."""
    packed = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select(*keep, F.inline(F.array(packed)))
