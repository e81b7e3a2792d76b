"""Structural fingerprints of records and stratified samples of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import api as A
from millrace.functions import html as H
from millrace.functions import text as T

SCAN = 200_000  # characters of a page that shape its fingerprint


def fingerprint(records: DataFrame) -> DataFrame:
    """``records`` with ``features`` (JSON text) and ``fingerprint`` (16 hex digits)."""
    p, city = F.col("payload"), F.col("city")
    part = F.substring("payload", 1, SCAN)
    bare = lambda c: F.regexp_replace(c, "<[^>]+>", " ")
    title = F.regexp_extract(part, r"(?is)<title[^>]*>(.*?)</title", 1)
    heads = F.slice(F.regexp_extract_all(part, F.lit(r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>"), F.lit(1)), 1, 5)
    count = lambda pattern: F.size(F.regexp_extract_all(part, F.lit(pattern), F.lit(0)))
    common = [F.col("payload_type").alias("payload_type"), T.domain(F.col("url")).alias("domain"), T.normalized_path(F.col("url")).alias("path"), T.size_bucket(p).alias("size_bucket")]
    page = F.struct(
        *common, T.shape(title, city).alias("title_shape"), F.transform(heads, lambda h: T.shape(bare(h), city)).alias("headings"), count(r"(?i)<form\b").alias("forms"),
        count(r"(?i)<script[^>]+(?:json|__next_data__|initial)").alias("json_scripts"), H.signals(part).alias("signals"),
    )
    v = A.parse(p)
    keys = lambda x: F.array_sort(F.map_keys(F.try_variant_get(x, "$", "map<string,variant>")))
    inner = F.get(F.filter(F.map_values(F.try_variant_get(v, "$", "map<string,variant>")), A.is_list), F.lit(0))
    items = F.coalesce(F.try_variant_get(F.when(A.is_list(v), v).otherwise(inner), "$", "array<variant>"), F.array().cast("array<variant>"))
    seen = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(F.slice(items, 1, 3), A.is_object), keys))))
    data = F.struct(
        *common, F.when(v.isNull(), "invalid").when(A.is_object(v), "dict").when(A.is_list(v), "list").otherwise("scalar").alias("root"),
        F.slice(keys(v), 1, 20).alias("top_keys"), F.least(F.size(items), F.lit(10)).alias("item_count_bucket"), F.slice(seen, 1, 30).alias("item_keys"),
    )
    features = F.when(F.col("payload_type") == "json", F.to_json(data)).otherwise(F.to_json(page))
    return records.withColumn("features", features).withColumn("fingerprint", F.substring(F.sha2("features", 256), 1, 16))


def stratified(rows: DataFrame, group: str, order: str, train: int = 4, holdout: int = 3, smoke: int = 2, max_groups: int = 24) -> DataFrame:
    """Rows of the first groups, taken in turn, dealt to disjoint splits (``split``, ``place``)."""
    total = train + holdout + smoke
    per = max(total, 2)
    # The first rows of each group; then as many groups as count.
    inner = Window.partitionBy(group).orderBy(order)
    heads = rows.withColumn("__k", F.row_number().over(inner)).where(F.col("__k") <= per)
    firsts = heads.where("__k = 1").select(F.col(group).alias("__g"), F.col(order).alias("__first")).orderBy("__first").limit(max_groups)
    # At most max_groups * per rows from here on.
    few = heads.join(F.broadcast(firsts), F.col(group).eqNullSafe(F.col("__g")))
    place = F.row_number().over(Window.orderBy("__k", "__first"))
    split = F.when(F.col("place") <= train, "train").when(F.col("place") <= train + holdout, "holdout").when(F.col("place") <= total, "smoke")
    return few.withColumn("place", place).withColumn("split", split).where("split is not null").drop("__k", "__g", "__first")
