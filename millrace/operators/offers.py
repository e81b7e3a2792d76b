"""From candidate cards and catalogue items to offers.

Columns: blocks are found by Arrow functions (``functions.html``); what a block says,
which blocks count, and everything about catalogue items are Column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import api as A
from millrace.functions import html as H
from millrace.functions import text as T

# Allowances and services in a block's text.
TV_COUNT = [
    r"(?iuU)(?<!\d)(\d{1,4})\s*\+?\s*(?:тв[-\s]?канал|канал(?:ов|а)?\s+тв|tv\s*channels?)",
    r"(?iuU)(?<!\d)(\d{1,4})\s*\+?\s*канал(?:ов|а)?\b",
    r"(?iumU)^(?:телевидение|тв|television)\s*\n\s*(\d{1,4})\s*\+?",
]
TV_WORD = r"(?iuU)(?:телевид|\bтв\b|\btv\b)"
MINUTES = r"(?iuU)(?<!\d)(\d{2,5})\s*(?:мин(?:ут)?|minutes?)\b"
DATA = r"(?iuU)(?<!\d)(\d+(?:[.,]\d+)?)\s*(?:гб|gb)\b"
NO_TV = r"(?iumU)^Без\s+ТВ\s*$"
BLOCK_SERVICES = [
    ("mobile", r"(?iuU)(?:мобильн|сим[-\s]?карт|\bмин(?:ут)?\b)"),
    ("cinema", r"(?iuU)(?:кинопоиск|кинотеатр|cinema|wink)"),
    ("gaming", r"(?iuU)(?:игров|gaming|game)"),
]
TV_SERVICE = r"(?iuU)(?:тв[-\s]?канал|телевид|\bтв\b|\btv\b)"
PREPAID = r"(?iuU)(\d+)\s+месяц\w*.*?в\s+размере\s+(\d+)\s+руб.*?из\s+расчета\s*[-—]?\s*(\d+)\s+руб"
UNKNOWN_BILLING = r"Цена тарифа:\s*(\d+(?:[.,]\d+)?)\s*₽"
PAIR = r"(?iuU)^(\d{2,8})\s+(\d{2,8})\s*(?:руб\.?|₽)\s*/\s*мес$"
MAX_SPEED_NAMES = r"(?iuU)^(?:МТС\s+Дома|РИИЛ\s+Плюс)"
EQUIPMENT_PART = r"(?iumU)^(?:мобильная\s+связь\s*$|роутер|оборудован|аренд)"
EMPTY_NAMES = r"(?iuU)^(?:возможно,?\s+вас\s+заинтересует|узнать\s+подробнее)$"
NOT_A_SPEED = r"(?iuU)(?:антивирус|security|роутер|аренд|руб|₽)"
ONLY_LABEL = r"(?iuU)^(?:тариф|план|offer|plan|домашн\w*\s+интернет)$"
SIGNATURE = ["name", "price", "price_old", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb"]
OUTPUT_COLUMNS = (
    "provider city region source_url timestamp availability name variant_id price price_old price_period connection_cost technology "
    "internet_speed_mbps tv_channels mobile_minutes mobile_data_gb services source_record_id evidence raw_offer conditions optional_services billing_variants"
).split()


def offer_speeds(block: Column, name: Column) -> Column:
    """Speeds of a block; else a plausible number in its name."""
    found = T.speeds(block)
    usable = (name != "") & ~name.rlike(NOT_A_SPEED) & ~name.rlike(ONLY_LABEL)
    named = F.filter(T.doubles(F.regexp_extract_all(name, F.lit(r"(?:^|\s)(\d{2,4})(?=$|\s|/|\+)"), F.lit(1))), lambda v: v.between(10, 10_000))
    return F.when(F.size(found) > 0, found).when(usable, named).otherwise(F.array().cast("array<double>"))


def with_block_facts(df: DataFrame, block: str = "block") -> DataFrame:
    """``df`` with ``facts``: what each block says, and ``usable``: it has a monthly price and a speed."""
    b = F.col(block)
    d = df.withColumn("__ls", T.lines(b)).withColumn("__m", T.monthly_prices(b))
    titled = (F.get("__ls", F.lit(0)) == "[DOM CARD TITLE]") & (F.size("__ls") > 1)
    d = d.withColumn("__name", F.when(titled, F.get("__ls", F.lit(1))).otherwise(T.commercial_name(F.col("__ls"))))
    d = d.withColumn("__in", F.filter("__ls", lambda x: ~x.rlike(T.OPTIONAL_LINE)))
    d = d.withColumn("__body", F.array_join("__in", "\n"))
    script = F.nullif(F.regexp_extract(b, T.SCRIPT_SPEED, 1), F.lit(""))
    d = d.withColumn("__name", F.when(script.isNotNull(), F.concat(F.lit("Интернет "), script, F.lit(" Мбит/с"))).otherwise(F.col("__name")))
    at = F.instr(F.col("__body"), F.col("__name"))
    behind = F.when((at > 0) & (F.col("__name") != ""), F.substr("__body", at + F.length("__name")))
    d = d.withColumn("__s1", T.speeds(F.coalesce(behind, F.lit("")))).withColumn("__s2", offer_speeds(F.col("__body"), F.col("__name")))
    d = d.withColumn("__sp", F.when(F.size("__s1") > 0, F.col("__s1")).otherwise(F.col("__s2")))
    # Cards of these names list alternative speeds: the largest one before the equipment part counts.
    place = F.instr(b, F.col("__name"))
    part = F.get(F.split(F.substr(b, F.greatest(F.lit(1), place + F.length("__name"))), EQUIPMENT_PART, 2), F.lit(0))
    d = d.withColumn("__s3", F.when(F.col("__name").rlike(MAX_SPEED_NAMES), T.speeds(part)))
    d = d.withColumn("__sp", F.when(F.size("__s3") > 0, F.array(F.array_max("__s3"))).otherwise(F.col("__sp")))
    speed = F.get("__sp", F.lit(0))
    shown = F.when(speed == F.floor(speed), speed.cast("long").cast("string")).otherwise(speed.cast("string"))
    dull = F.col("__name").rlike(r"^\d+(?:[.,]\d+)?$") | F.col("__name").rlike(T.MONTHLY) | F.col("__name").rlike(EMPTY_NAMES)
    d = d.withColumn("__name", F.when(dull & speed.isNotNull(), F.concat(F.lit("Интернет "), shown, F.lit(" Мбит/с"))).otherwise(F.col("__name")))
    d = d.withColumn("__y", T.yearly_prices(b))
    body = F.col("__body")
    first = lambda p: F.nullif(F.regexp_extract(body, p, 1), F.lit("")).try_cast("int")
    tv = F.coalesce(first(TV_COUNT[0]), F.when(body.rlike(TV_WORD), first(TV_COUNT[1])), first(TV_COUNT[2]))
    has_tv = body.rlike(TV_SERVICE) & ~(body.rlike(NO_TV) & tv.isNull())
    unknown = F.when(F.contains(b, F.lit("[UNSPECIFIED BILLING]")), T.plain_double(F.nullif(F.regexp_extract(b, UNKNOWN_BILLING, 1), F.lit(""))))
    d = d.withColumn("__p", F.coalesce(F.get("__m", F.lit(0)), F.get("__y", F.lit(0)), unknown))
    promo = b.rlike(T.DISCOUNT)
    d = d.withColumn("__so", F.when(promo, T.standalone_old_price(F.col("__ls"), F.col("__p"))))
    pair = F.filter("__ls", lambda x: (T.plain_double(F.regexp_extract(x, PAIR, 2)) == F.col("__p")) & (T.plain_double(F.regexp_extract(x, PAIR, 1)) > F.col("__p")))
    inline = T.plain_double(F.regexp_extract(F.get(pair, F.lit(0)), PAIR, 1))
    rest = F.slice("__m", 2, F.greatest(F.size("__m"), F.lit(1)))
    larger = F.when(promo, F.array_max(F.filter(rest, lambda v: v > F.col("__p"))))
    bill = F.filter("__ls", lambda x: x.rlike(PREPAID))
    nothing = F.lit(None)
    bills = F.array_distinct(
        F.transform(
            bill,
            lambda x: F.struct(
                nothing.cast("string").alias("type"), nothing.cast("double").alias("price"), nothing.cast("double").alias("price_old"), nothing.cast("string").alias("price_period"),
                nothing.cast("string").alias("conditions"), F.regexp_extract(x, PREPAID, 1).try_cast("int").alias("prepaid_months"),
                F.regexp_extract(x, PREPAID, 2).try_cast("double").alias("upfront_price"), F.regexp_extract(x, PREPAID, 3).try_cast("double").alias("monthly_equivalent"),
            ),
        )
    )
    services = F.filter(
        F.array(F.lit("internet"), F.when(has_tv, F.lit("tv")), *[F.when(body.rlike(p), F.lit(n)) for n, p in BLOCK_SERVICES]), lambda x: x.isNotNull()
    )
    period = F.when(F.size("__m") > 0, "месяц").when(F.size("__y") > 0, "год")
    facts = F.struct(
        F.col("__name").alias("name"), nothing.cast("string").alias("variant_id"), F.col("__p").alias("price"), F.coalesce("__so", inline, larger).alias("price_old"),
        period.alias("price_period"), nothing.cast("double").alias("connection_cost"), nothing.cast("string").alias("technology"),
        F.get("__sp", F.lit(0)).alias("internet_speed_mbps"), tv.alias("tv_channels"),
        F.array_max(F.transform(F.regexp_extract_all(body, F.lit(MINUTES), F.lit(1)), lambda v: v.try_cast("int"))).alias("mobile_minutes"),
        F.array_max(T.doubles(F.regexp_extract_all(body, F.lit(DATA), F.lit(1)))).alias("mobile_data_gb"),
        services.alias("services"), F.array_distinct(F.filter("__ls", lambda x: x.rlike(T.CONDITION_LINE))).alias("conditions"),
        F.filter("__ls", lambda x: x.rlike(T.OPTIONAL_LINE)).alias("optional_services"), bills.alias("billing_variants"),
    )
    usable = (F.size("__m") > 0) & (F.size("__sp") > 0)
    return d.withColumn("facts", facts.cast(A.FACT_DDL)).withColumn("usable", usable).select(*df.columns, "facts", "usable")


def html_offers(pages: DataFrame, key: str = "source_record_id", payload: str = "payload") -> DataFrame:
    """(key, block, at, facts): the offers of each page.

    Known card families win. Otherwise headed blocks, else the one tariff of a detail
    page, else script fields; rows paired
    from speeds and prices replace a single or missing block if they are more; lines
    that name an internet speed replace what they are not fewer than. Of blocks with
    equal facts the first stays. ``key`` must be unique.
    """
    found = H.with_candidates(pages.select(key, payload), payload).select(key, F.posexplode("candidates").alias("at", "c"))
    rows = with_block_facts(found.select(key, "at", "c.tier", "c.block"))
    # From here on by page: facts are computed once, before the exchange.
    rows = rows.withColumn("fit", F.col("usable") | (F.col("tier") == "dom")).repartition(key)
    rows = rows.withColumn("sig", F.to_json(F.struct(*[F.col("facts")[c].alias(c) for c in SIGNATURE])))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(key, "tier", "fit", "sig").orderBy("at")))
    page = Window.partitionBy(key)
    n = lambda t: F.count_if(F.col("fit") & (F.col("nth") == 1) & (F.col("tier") == t)).over(page)
    rows = rows.select("*", *[n(t).alias(f"n_{t}") for t in H.TIERS])
    base = F.when(F.col("n_headed") > 0, "headed").when(F.col("n_detail") > 0, "detail").when(F.col("n_script") > 0, "script")
    base_n = F.when(base == "headed", F.col("n_headed")).when(base == "detail", F.col("n_detail")).when(base == "script", F.col("n_script")).otherwise(0)
    second = F.when((base_n <= 1) & (F.col("n_paired") > base_n), "paired").otherwise(base)
    second_n = F.when(second == "paired", F.col("n_paired")).otherwise(base_n)
    pick = F.when(F.col("n_dom") > 0, "dom").when((F.col("n_named") > 0) & (F.col("n_named") >= second_n), "named").otherwise(second)
    return rows.where(F.col("fit") & (F.col("nth") == 1) & (F.col("tier") == pick)).select(key, "at", "block", "facts")


def json_offers(records: DataFrame, key: str = "source_record_id", payload: str = "payload") -> DataFrame:
    """(key, at, raw, option, facts): the offers of each catalogue response."""
    items = records.select(key, F.posexplode(A.items(A.parse(F.col(payload)))).alias("i", "item"))
    each = items.select(key, "i", F.posexplode(A.variants(F.col("item"))).alias("j", "v"))
    return each.select(key, (F.col("i") * 100_000 + F.col("j")).alias("at"), F.col("v.item").alias("item"), F.col("v.option").alias("option"), A.facts(F.col("v.item"), F.col("v.option")).alias("facts"))
