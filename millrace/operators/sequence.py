"""Operators over ordered lines: neighbours, sessions, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbours(df: DataFrame, key: list[str], order: str, value: Column, before: int, after: int) -> DataFrame:
    """``previous`` and ``following``: the nearest non-null values within so many rows."""
    w = Window.partitionBy(*key).orderBy(order)
    return df.withColumn("previous", F.last(value, ignorenulls=True).over(w.rowsBetween(-before, -1))).withColumn("following", F.first(value, ignorenulls=True).over(w.rowsBetween(1, after)))


def sessions(df: DataFrame, key: list[str], order: str, starts: Column) -> DataFrame:
    """``session``: how many starts there were so far."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("session", F.sum(F.coalesce(starts, F.lit(False)).cast("long")).over(w))


def gaps(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """``gap``: whether the row before isn't the direct neighbour."""
    w = Window.partitionBy(*key).orderBy(order)
    return df.withColumn("gap", F.coalesce(F.col(order) - F.lag(order).over(w) > 1, F.lit(True)))


def lines_within(df: DataFrame, text: str, budget: int) -> DataFrame:
    """``kept``, ``kept_chars``: the first whole lines of a text within a budget of characters (each with its break)."""
    ls = F.split(text, "\n")
    step = lambda acc, x: F.struct(
        (acc["n"] + (acc["open"] & (acc["used"] + F.length(x) + 1 <= budget)).cast("int")).alias("n"),
        F.when(acc["open"] & (acc["used"] + F.length(x) + 1 <= budget), acc["used"] + F.length(x) + 1).otherwise(acc["used"]).alias("used"),
        (acc["open"] & (acc["used"] + F.length(x) + 1 <= budget)).alias("open"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(True).alias("open"))
    return df.withColumn("__b", F.aggregate(ls, zero, step)).withColumn("kept", F.col("__b.n")).withColumn("kept_chars", F.col("__b.used")).drop("__b")
