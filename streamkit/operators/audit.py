"""Counts around table changes and per-micro-batch metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pred(p: str | Column) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def count_where(df: DataFrame, predicate: str | Column, alias: str = "cnt") -> DataFrame:
    """One-row frame: ``count_if(predicate)`` (NULL predicate counts as false)."""
    return df.agg(F.count_if(F.coalesce(_pred(predicate), F.lit(False))).alias(alias))


def counts(df: DataFrame, **predicates: str | Column) -> DataFrame:
    """One row with ``total`` and one ``count_if`` column per named predicate."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(F.coalesce(_pred(p), F.lit(False))).alias(n) for n, p in predicates.items()])


def delta_count(before: int, after: int) -> dict:
    return {"before": before, "after": after, "delta": after - before}


def batch_metrics(df: DataFrame, name: str, **predicates: str | Column) -> DataFrame:
    """Attach ``observe`` metrics (row count and named ``count_if``s) to a
    frame.  In a stream they arrive in each progress's ``observedMetrics``;
    they are computed by the query itself, without a second pass."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(F.coalesce(_pred(p), F.lit(False))).alias(n) for n, p in predicates.items()])
