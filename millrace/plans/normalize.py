"""The main plan: records to offers, rejected records and statistics.

read, alias and route, extract, validate, split. A record whose offers hold one error
gives no offers. Payloads stay out of shuffles: offers are matched to records by id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import api as A
from millrace.operators import offers as O
from millrace.operators import validate as V

# Provider aliases, providers with adapters, states that pass.
ALIASES = {"wifire_ru": "wifireru", "ooofirmaintersvyaz": "intersvyaz"}
ADAPTERS = {
    "mts": ("json", "html"), "beeline": ("json", "html"), "wifireru": ("json", "html"), "ones": ("json", "html"), "rtk": ("json", "html"),
    "intersvyaz": ("html",), "letai": ("html",), "ttk": ("html",), "profintel": ("html",), "sibset": ("html",), "wifire": ("html",),
}
FALLBACK = "ones"
PASSING_STATES = ["success", "ok", "200"]


def alias(provider: Column) -> Column:
    out = provider
    for old, new in ALIASES.items():
        out = F.when(provider == old, new).otherwise(out)
    return out


def route(provider: Column) -> Column:
    """The adapter of a provider; a general one for unknown or unsafe names."""
    return F.when(provider.isin(list(ADAPTERS)), provider).otherwise(FALLBACK)


@dataclass
class Result:
    offers: DataFrame
    errors: DataFrame
    records: DataFrame  # a row for each record, with its outcome

    def stats(self) -> DataFrame:
        return statistics(self.records)


def keep_first(records: DataFrame, completed: DataFrame | None = None) -> DataFrame:
    """``skipped``: a record whose id came before, in this input or among ``completed`` (source_record_id)."""
    w = Window.partitionBy("source_record_id").orderBy("seq")
    ids = records.select("source_record_id", "seq").withColumn("skipped", F.row_number().over(w) > 1)
    if completed is not None:
        done = completed.select("source_record_id").distinct().withColumn("__done", F.lit(True))
        ids = ids.join(done, "source_record_id", "left").withColumn("skipped", F.col("skipped") | F.coalesce("__done", F.lit(False))).drop("__done")
    return records.join(ids.select("seq", "skipped"), "seq")


def refusal() -> Column:
    """Why a record isn't read, by its status, payload, payload_type and adapter; null where it is."""
    allowed = F.lit(False)
    for name, kinds in ADAPTERS.items():
        allowed = allowed | ((F.col("adapter") == name) & F.col("payload_type").isin(list(kinds)))
    state = F.lower(F.coalesce("status", F.lit("")))
    broken = (F.col("payload_type") == "json") & A.parse(F.col("payload")).isNull()
    return (
        F.when((state != "") & ~state.isin(PASSING_STATES), F.concat(F.lit("source status: "), F.col("status")))
        .when(F.trim("payload") == "", "empty payload")
        .when(~allowed, "unsupported payload type")
        .when(broken, "invalid JSON")
    )


def normalize(records: DataFrame, only_provider: str | None = None, completed: DataFrame | None = None) -> Result:
    """Offers, errors and outcomes of the records."""
    r = records.withColumn("alias", alias(F.col("provider")))
    if only_provider is not None:
        r = r.where(F.col("alias") == only_provider)
    r = keep_first(r, completed).withColumn("adapter", route(F.col("alias")))
    r = r.withColumn("refusal", F.when(~F.col("skipped"), refusal()))
    open_ = r.where(~F.col("skipped") & F.col("refusal").isNull())
    found = extract(open_)
    checked = V.validate(open_, found)
    report = checked.groupBy("source_record_id").agg(
        F.count("facts").alias("n_offers"), F.flatten(F.collect_list(F.struct("at", "errors"))["errors"]).alias("offer_errors"), F.max("record_errors").alias("record_errors")
    )
    done = r.drop("payload").join(report, "source_record_id", "left")
    none = F.array().cast("array<string>")
    bad = F.concat(F.coalesce("record_errors", none), F.coalesce("offer_errors", none))
    done = done.withColumn("problems", F.when(F.col("skipped"), none).when(F.col("refusal").isNotNull(), F.array("refusal")).otherwise(bad))
    done = done.withColumn("ok", ~F.col("skipped") & (F.size("problems") == 0)).withColumn("n_offers", F.when(F.col("ok"), F.coalesce("n_offers", F.lit(0))).otherwise(F.lit(0)))
    fine = done.where("ok").select("seq", "source_record_id", "provider", "city", "region", "url", "timestamp")
    offers = checked.where(F.col("facts").isNotNull()).join(fine, "source_record_id")
    meta = ["seq", "source_record_id", "provider", "city", "region", "url", "timestamp", "payload_type", "status"]
    errors = done.where(~F.col("ok") & ~F.col("skipped")).select(*meta, F.array_join("problems", "; ").alias("error"))
    return Result(offer_rows(offers), errors, done)


def extract(records: DataFrame) -> DataFrame:
    """(source_record_id, at, block, item, option, facts) of all records, pages and responses apart."""
    html = O.html_offers(records.where("payload_type = 'html'")).withColumn("item", F.lit(None).cast("variant")).withColumn("option", F.lit(None).cast("variant"))
    data = O.json_offers(records.where("payload_type = 'json'")).withColumn("block", F.lit(None).cast("string"))
    cols = ["source_record_id", F.col("at").cast("long").alias("at"), "block", "item", "option", "facts"]
    return html.select(*cols).union(data.select(*cols))


def offer_rows(offers: DataFrame) -> DataFrame:
    """The output table, in its order of columns, with ``seq`` and ``at`` to sort by."""
    f = lambda c: F.col("facts")[c].alias(c)
    raw = F.when(F.col("block").isNotNull(), F.parse_json(F.to_json(F.struct("block")))).when(F.col("option").isNotNull(), F.parse_json(F.concat(F.lit('{"internet_option":'), F.to_json("option"), F.lit(',"offer":'), F.to_json("item"), F.lit("}")))).otherwise(F.col("item"))
    made = {
        "source_url": F.col("url").alias("source_url"), "availability": F.lit("available").alias("availability"), "evidence": F.array().cast("array<string>").alias("evidence"),
        "raw_offer": raw.alias("raw_offer"),
    }
    own = {"provider", "city", "region", "timestamp", "source_record_id"}
    return offers.select(*[made[c] if c in made else F.col(c) if c in own else f(c) for c in O.OUTPUT_COLUMNS], "seq", "at")


def statistics(outcomes: DataFrame) -> DataFrame:
    """Counters by provider and, with a null provider, of all: one pass."""
    tried = ~F.col("skipped")
    got = outcomes.rollup("provider").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("skipped").alias("skipped"), F.count_if("ok").alias("succeeded"),
        F.count_if(tried & ~F.col("ok")).alias("failed"), F.count_if(F.col("ok") & (F.col("n_offers") == 0)).alias("empty"), F.sum("n_offers").alias("offers"),
    )
    return got.withColumn("success_rate", F.col("succeeded") / F.greatest(F.lit(1), F.col("records") - F.col("skipped")))
