"""Checks of offers against their sources, as arrays of error texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import api as A
from millrace.functions import text as T

NUMERIC = ["price", "price_old", "connection_cost", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb"]
GROUNDED = ["price", "price_old", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb"]


def fact_errors(f) -> list:
    """Checks of the facts by themselves."""
    out = [F.when(F.trim(F.coalesce(f["name"], F.lit(""))) == "", "empty name")]
    out += [F.when(f[c] < 0, f"invalid {c}") for c in NUMERIC]
    out.append(F.when(f["price_old"] < f["price"], "price_old is lower than price"))
    return out


def evidence_grounded(evidence, payload):
    """Whether every piece of evidence stands in the payload, regardless of case."""
    return F.forall(evidence, lambda e: (e == "") | F.contains(F.lower(payload), F.lower(e)))


def strict_extraction_errors(v):
    """Checks of a model's answer: field types, negatives, no offers where nothing is available."""
    offers = A.get(v, "$.offers", "array<variant>")
    state = A.text_of(v, "$.availability")
    numbers = [F.when(F.exists(offers, lambda o, c=c: ~F.coalesce(F.schema_of_variant(A.get(o, f"$.{c}")).rlike("^(VOID|BIGINT|DOUBLE|DECIMAL)"), F.lit(True))), f"{c} is no number") for c in NUMERIC]
    below = [F.when(F.exists(offers, lambda o, c=c: F.coalesce(A.get(o, f"$.{c}", "double") < 0, F.lit(False))), f"{c} is negative") for c in NUMERIC]
    own = [
        F.when(~A.is_object(v), "not an object"),
        F.when(~F.coalesce(state.isin("available", "unavailable", "unknown"), F.lit(False)), "availability"),
        F.when(offers.isNull(), "offers is no list"),
        F.when((state == "unavailable") & (F.size(offers) > 0), "offers although unavailable"),
    ]
    return F.array_compact(F.array(*own, *numbers, *below))


def validate(records: DataFrame, offers: DataFrame) -> DataFrame:
    """``offers`` with ``errors``, and a row with null facts for records without any, with ``record_errors``.

    Numbers of an offer must stand in what it was read from: its block, or for flat items
    the item. Catalogue kinds are recomputed from their items by construction.
    """
    f = F.col("facts")
    same = F.struct(F.lower(f["name"]).alias("n"), *[f[c].alias(c) for c in ("price", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb", "variant_id")])
    twice = F.count(F.lit(1)).over(Window.partitionBy("source_record_id", F.to_json(same))) > 1
    source = F.coalesce("block", F.to_json("item"))
    d = offers.withColumn("__numbers", T.numbers_in(source)).withColumn("__speeds", F.when(F.col("block").isNotNull(), T.speeds(source)).otherwise(F.array().cast("array<double>")))
    d = d.withColumn("__own", F.col("item").isNotNull() & A.kind(F.col("item")).isNotNull()).withColumn("__twice", twice)
    free = []
    for c in GROUNDED:
        v = f[c].cast("double")
        known = F.array_contains("__numbers", v)
        if c == "internet_speed_mbps":
            known = known | F.array_contains("__speeds", v)
        free.append(F.when(~F.col("__own") & v.isNotNull() & ~F.coalesce(known, F.lit(False)), F.concat(F.lit(f"{c}="), v.cast("string"), F.lit(" is not grounded"))))
    dup = F.when(F.col("__twice"), "duplicate offer")
    d = d.withColumn("errors", F.array_compact(F.array(*fact_errors(f), dup, *free))).drop("__numbers", "__speeds", "__own", "__twice")
    # Responses that list items must give offers.
    listed = records.select("source_record_id", F.when(F.col("payload_type") == "json", F.size(A.items(A.parse(F.col("payload"))))).otherwise(0).alias("n_items"))
    none = F.array().cast("array<string>")
    out = listed.join(d, "source_record_id", "left")
    missing = F.when((F.col("n_items") > 0) & f.isNull(), F.array(F.lit("non-empty structured offer list produced no offers"))).otherwise(none)
    return out.withColumn("record_errors", missing).withColumn("errors", F.coalesce("errors", none)).drop("n_items")
