"""Offers of any maker held against the records that they claim to come from.

Offers are rows (source_record_id, at, facts, raw: variant), ``raw`` being the catalogue
item, ``{"offer":, "internet_option":}`` or ``{"block":}``. Pages are read again, items
recomputed; each fault is a row (source_record_id, at, error), ``at`` null where it is
the record's. Sources and offers meet by (record, hash of the canonical text), so that
payloads take part in no shuffle and a record of many items is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import api as A
from millrace.functions import text as T
from millrace.functions import tree as J
from millrace.operators import offers as O

# Facts that a block, a catalogue card or a flat item must agree on.
BLOCK_FACTS = ["name", "price", "price_old", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb"]
CARD_FACTS = [
    "name", "variant_id", "price", "price_old", "price_period", "connection_cost", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb",
    "services", "conditions", "optional_services", "billing_variants",
]
FLAT_NUMBERS = {"price": "price", "price_old": "price_old", "connection_cost": "costConnection"}
FLAT_TEXTS = {"name": "name", "price_period": "pricePeriod", "technology": "tech"}
KEYED_NUMBERS = {
    "internet_speed_mbps": ["speedVal", "internet_speed_mbps", "speed"], "tv_channels": ["tv_channels", "channelsCount", "channelCount"],
    "mobile_minutes": ["mobile_minutes", "minutes", "minutesCount"], "mobile_data_gb": ["mobile_data_gb", "dataGb", "internetTraffic"],
}
PRODUCT_SERVICES = {
    "SHPD": "internet", "IPTV": "tv", "ITV": "tv", "SOTOVAYA_SVYAZ_MVNO": "mobile", "VIRTUAL_MVNO": "mobile", "ONLINE_CINEMA": "cinema", "GAMING_ADVANTAGES": "gaming",
}
# Further ways to write a recurring price.
RECURRING_PRICES = [
    r"(?iu)(?<!\d)(\d[\d  ]{0,8}(?:[.,]\d+)?)\s*(?:₽|руб(?:\.|лей)?|р\.?)\s*(?:/|в\s+)?\s*(?:мес|месяц)",
    r"(?iu)(?:мес(?:яц)?|month)\s+(?:всего\s+|за\s+|for\s+)?(\d+(?:[.,]\d+)?)\s*(?:₽|руб(?:\.|лей)?|rub)",
    r"(?iu)(?<!\d)(\d{2,8}(?:[.,]\d+)?)\s*\n\s*(?:₽|руб(?:\.|лей)?|р\.?)?\s*/?\s*(?:мес|месяц)",
]
SCRIPT_SPEED_KEY = r"(?i)speed(?:OwnHouse)?[\\\"]*\s*:"
SCRIPT_PRICE = r"(?i)price(?:OwnHouse)?[\\\"]*\s*:\s*[\\\"]*(\d+(?:[.,]\d+)?)"
SOURCE_PRICE = r"(?s)\[SOURCE PRICE\]\s*<\w+\b[^>]*data-cost=[\"'](\d+(?:\.\d+)?)[\"']"


def _key(text: Column) -> Column:
    return F.sha2(text, 256)


def _own(raw: Column) -> tuple[Column, Column]:
    """The item and the option that a raw offer is made of."""
    option = A.get(raw, "$.internet_option")
    return F.when(option.isNotNull(), A.get(raw, "$.offer")).otherwise(raw), option


def recurring_price(price: Column, block: Column) -> Column:
    """Whether the block gives the price as one paid each month."""
    found = F.concat(*[T.doubles(F.regexp_extract_all(block, F.lit(p), F.lit(1))) for p in RECURRING_PRICES])
    script = F.when(block.rlike(SCRIPT_SPEED_KEY), T.doubles(F.regexp_extract_all(block, F.lit(SCRIPT_PRICE), F.lit(1))))
    hit = lambda prices: F.coalesce(F.array_contains(prices, price), F.lit(False))
    return hit(T.monthly_prices(block)) | hit(found) | hit(script)


def price_kind(price: Column, period: Column, block: Column) -> Column:
    """monthly, yearly, unspecified (the source names no period), or null: the block doesn't bear the price."""
    yearly = (period == "год") & F.array_contains(T.yearly_prices(block), price)
    named = F.nullif(F.regexp_extract(block, SOURCE_PRICE, 1), F.lit("")).try_cast("double")
    open_ = period.isNull() & F.contains(block, F.lit("[UNSPECIFIED BILLING]")) & (named == price)
    return F.when(yearly, "yearly").when(recurring_price(price, block), "monthly").when(open_, "unspecified")


def _rows(df: DataFrame, errors: list[Column]) -> DataFrame:
    return df.select("source_record_id", "at", F.explode(F.array_compact(F.array(*errors))).alias("error"))


def page_faults(records: DataFrame, offers: DataFrame) -> DataFrame:
    """Offers of pages against the blocks that the pages hold."""
    pages = records.where("payload_type = 'html'")
    blocks = O.html_offers(pages).select("source_record_id", _key(F.col("block")).alias("k"), F.col("facts").alias("wanted"))
    blocks = blocks.groupBy("source_record_id", "k").agg(F.count(F.lit(1)).alias("n"), F.first("wanted").alias("wanted"))
    own = offers.join(pages.select("source_record_id"), "source_record_id", "left_semi").withColumn("block", F.try_variant_get("raw", "$.block", "string"))
    own = own.withColumn("k", _key(F.coalesce("block", F.lit(""))))
    held = own.join(blocks, ["source_record_id", "k"], "left")
    held = held.withColumn("nth", F.row_number().over(Window.partitionBy("source_record_id", "k").orderBy("at")))
    f, w = F.col("facts"), F.col("wanted")
    kept = w.isNotNull()
    same = lambda c: T.folded(F.coalesce(f[c], F.lit(""))) == T.folded(F.coalesce(w[c], F.lit(""))) if c == "name" else f[c].eqNullSafe(w[c])
    differ = [F.when(kept & ~same(c), f"{c} differs from its block") for c in BLOCK_FACTS]
    unpaid = kept & f["price"].isNotNull() & price_kind(f["price"], f["price_period"], F.col("block")).isNull()
    found = _rows(held, [F.when(~kept, "raw_offer is no block of the page"), F.when(kept & (F.col("nth") > 1), "block used again"), *differ, F.when(unpaid, "price is not a recurring monthly price")])
    want = blocks.groupBy("source_record_id").agg(F.sum("n").alias("want"))
    have = own.groupBy("source_record_id").agg(F.count(F.lit(1)).alias("have"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    counts = want.join(have, "source_record_id", "full_outer").where(~F.col("want").eqNullSafe(F.col("have")))
    told = F.concat(F.lit("expected "), zero("want"), F.lit(" offers, got "), zero("have"))
    return found.union(counts.select("source_record_id", F.lit(None).cast("long").alias("at"), told.alias("error")))


def item_sources(records: DataFrame) -> DataFrame:
    """(source_record_id, k, expected, native): what raw offers a response's items can give, and whether a full reading gives it."""
    none = F.array().cast("array<variant>")

    def of_item(item: Column, native: Column) -> Column:
        options = F.coalesce(A.get(item, "$.internetOptions", "array<variant>"), none)
        source = lambda text, expected: F.struct(text.alias("t"), expected.alias("expected"), native.alias("native"))
        # The order of the names is that of a canonical text.
        pair = lambda x, o: F.concat(F.lit('{"internet_option":'), F.to_json(o), F.lit(',"offer":'), x["t"], F.lit("}"))
        texts = lambda x: F.concat(F.array(source(x["t"], ~x["slider"])), F.transform(x["options"], lambda o: source(pair(x, o), x["slider"])))
        slider = lambda y: F.coalesce((A.kind(item) == "mts") & (F.size(y) > 0), F.lit(False))
        return T.let(options, lambda y: T.let(F.struct(F.to_json(item).alias("t"), slider(y).alias("slider"), y.alias("options")), texts))

    def of_items(items: Column) -> Column:
        return T.let(F.forall(items, lambda i: A.kind(i).isNotNull()), lambda native: F.flatten(F.transform(items, lambda i: of_item(i, native))))

    # One generator: of a column of its own the optimizer would make filters, which compute the items
    # again, and before the rows are dealt to all cores.
    rows = records.where("payload_type = 'json'").select("source_record_id", F.explode(T.let(A.items(A.parse(F.col("payload"))), of_items)).alias("x"))
    return rows.select("source_record_id", _key(F.col("x.t")).alias("k"), F.col("x.expected").alias("expected"), F.col("x.native").alias("native"))


def bag_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that two tables hold a different number of times, with both numbers (``in_a``, ``in_b``)."""
    count = lambda df, n: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    both = count(a, "in_a").join(count(b, "in_b"), keys, "full_outer").na.fill(0, ["in_a", "in_b"])
    return both.where("in_a <> in_b")


def item_faults(records: DataFrame, offers: DataFrame) -> DataFrame:
    """Offers of catalogue responses against their items: preserved, recomputed, and all of them there."""
    responses = records.where("payload_type = 'json'").select("source_record_id")
    sources = item_sources(records)
    own = offers.join(responses, "source_record_id", "left_semi").withColumn("k", _key(F.to_json("raw")))
    known = sources.select("source_record_id", "k").distinct().withColumn("kept", F.lit(True))
    held = own.join(known, ["source_record_id", "k"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    item, option = _own(F.col("raw"))
    held = held.withColumn("item", item).withColumn("card", A.kind(F.col("raw")).isNotNull())
    f, raw = F.col("facts"), F.col("raw")
    card = F.col("kept") & F.col("card")
    # Bound in a function, so that the facts are in the plan and computed once.
    card_errors = lambda w: F.array(*[F.when(~f[c].eqNullSafe(w[c]), f"{c} differs from the source") for c in CARD_FACTS])
    flat_errors = [F.when(f[c] != A.get(raw, f"$.{k}", "double"), f"{c} differs from the source") for c, k in FLAT_NUMBERS.items()]
    flat_errors += [F.when(T.folded(f[c]) != F.nullif(T.folded(A.text_of(raw, f"$.{k}")), F.lit("")), f"{c} differs from the source") for c, k in FLAT_TEXTS.items()]
    keyed = lambda ns: F.array(*[F.when(f[c].isNotNull() & ~F.array_contains(J.numbers_of(ns, keys), f[c].cast("double")), f"{c} stands under no matching key") for c, keys in KEYED_NUMBERS.items()])
    bound = lambda value, errors: F.flatten(F.transform(F.array(value), errors))
    out = F.when(~F.col("kept"), F.array(F.lit("raw_offer is no item of the response"))).when(card, bound(A.facts(F.col("item"), option), card_errors)).otherwise(F.concat(F.array(*flat_errors), bound(J.nodes(raw, J.NUMBER_DEPTH), keyed)))
    found = held.select("source_record_id", "at", F.explode(F.array_compact(out)).alias("error"))
    # Responses of cards only must give every card and slider variant once.
    full = sources.where("native")
    cover = bag_differences(full.where("expected").select("source_record_id", "k"), own.join(full.select("source_record_id").distinct(), "source_record_id", "left_semi").select("source_record_id", "k"), ["source_record_id", "k"])
    lost = cover.select("source_record_id").distinct().select("source_record_id", F.lit(None).cast("long").alias("at"), F.lit("cards or variants are missing, repeated or unexpected").alias("error"))
    return found.union(lost)


def faults(records: DataFrame, offers: DataFrame) -> DataFrame:
    """All faults of ``offers``, of pages and of responses."""
    return page_faults(records, offers).union(item_faults(records, offers))


def omissions(facts: Column, raw: Column) -> Column:
    """What an item states plainly and its offer leaves out: prices, services of products, the speed of internet products."""
    number = lambda c: A.number_of(raw, f"$.{c}")
    old_counts = ~F.coalesce(number("price_old") < number("price"), F.lit(False))
    prices = [F.when(number("price").isNotNull() & ~facts["price"].eqNullSafe(number("price")), "price left out"), F.when(number("price_old").isNotNull() & old_counts & ~facts["price_old"].eqNullSafe(number("price_old")), "price_old left out")]
    products = F.coalesce(A.get(raw, "$.products", "array<variant>"), F.array().cast("array<variant>"))
    names = F.create_map(*[F.lit(x) for kv in PRODUCT_SERVICES.items() for x in kv])

    def of_product(p: Column) -> Column:
        code = A.text_of(p, "$.productCode")
        label, speed = F.try_element_at(names, code), A.number_of(p, "$.speedVal")
        missing = label.isNotNull() & ~F.coalesce(F.array_contains(facts["services"], label), F.lit(False))
        return F.array(
            F.when(missing, F.concat(F.lit("service "), label, F.lit(" left out"))),
            F.when((code == "SHPD") & speed.isNotNull() & ~facts["internet_speed_mbps"].eqNullSafe(speed), "internet_speed_mbps left out"),
        )

    return F.array_compact(F.concat(F.array(*prices), F.flatten(F.transform(products, of_product))))
