"""Comparing snapshots, finding gold cases, resuming, and looking up localities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The fields that a snapshot comparison tracks.
TRACKED = ["price", "price_old", "costConnection", "tech", "packagesTypes", "products", "stockData", "lcs"]


def changes(old: DataFrame, new: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """(key, type, before, after): rows added, removed, or changed in a tracked column.

    ``before`` and ``after`` are maps of texts: all tracked columns for added and removed
    rows, the differing ones for changed rows. One full outer join; nulls are equal.
    """
    text = lambda df: F.map_from_arrays(F.array(*[F.lit(c) for c in tracked]), F.array(*[df[c].cast("string") for c in tracked]))
    a = old.select(F.col(key).alias("__k"), text(old).alias("before")).alias("a")
    b = new.select(F.col(key).alias("__k"), text(new).alias("after")).alias("b")
    # Other names than the output's: a name within a lambda may mean an output column.
    j = a.join(b, F.col("a.__k") == F.col("b.__k"), "full_outer").select(F.coalesce("a.__k", "b.__k").alias(key), F.col("before").alias("__a"), F.col("after").alias("__b"))
    differ = lambda side: lambda k, v: ~v.eqNullSafe(F.element_at(side, k))
    kind = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.size(F.map_filter("__a", differ("__b"))) > 0, "changed")
    both = F.col("type") == "changed"
    cut = lambda mine, other: F.when(both, F.map_filter(mine, differ(other))).otherwise(F.col(mine))
    return j.withColumn("type", kind).where("type is not null").select(key, "type", cut("__a", "__b").alias("before"), cut("__b", "__a").alias("after"))


def card_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes of two card snapshots (offer_id, card: variant)."""
    fields = lambda df: df.select("offer_id", *[F.to_json(F.try_variant_get("card", f"$.{c}", "variant")).alias(c) for c in TRACKED])
    who = lambda df: df.select("offer_id", *[F.try_variant_get("card", p, "string").alias(n) for n, p in (("provider", "$._provider"), ("city", "$._city"), ("name", "$.name"))])
    named = who(new).unionByName(who(old).join(new.select("offer_id"), "offer_id", "left_anti"))
    return changes(fields(old), fields(new), "offer_id", TRACKED).join(named, "offer_id").orderBy("offer_id")


def first_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def resume(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def pending(rows: DataFrame, done: DataFrame, key: str, order: str, city: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows still to do: of cities that contain a text, not done yet, and of those the first ones."""
    if city is not None:
        rows = rows.where(F.contains(F.lower("city"), F.lower(F.lit(city))))
    rows = resume(rows, done, key)
    return rows if limit is None else rows.orderBy(order).limit(limit)


def with_locality(rows: DataFrame, localities: DataFrame, city: str = "city") -> DataFrame:
    """``locality_id`` by the city's name in lower case; the map is read from one file and small by nature."""
    small = localities.count() <= 1_000_000
    dim = F.broadcast(localities) if small else localities
    return rows.join(dim, F.lower(F.col(city)) == F.col("city_key"), "left").drop("city_key")


def first_values(df: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """(key, first: the ``most`` least values in order, n: all rows). Spark limits each task's rows before the shuffle."""
    w = Window.partitionBy(key).orderBy(value)
    top = df.select(key, value).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most)
    lists = top.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias("first"))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(lists, key)


def best_by(df: DataFrame, keys: list[str], value: str, order: list[Column], out: str) -> DataFrame:
    """For each key the value of the row that is greatest in the order (of attempts: the best)."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias(out))
