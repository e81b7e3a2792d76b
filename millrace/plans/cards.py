"""Nested card documents from offers, and the clean-up of a model's offers before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

PRODUCT = "struct<code:string,productCode:string,priority:int,title:string,v:double,speedVal:double,codeTechnology:string,id:string,name:string,desc:string,iconText:double,unit:string>"


def _shown(c: Column) -> Column:
    """A number as texts show it: whole ones without a point."""
    return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))


def _product(**f: Column | str | int) -> Column:
    kinds = [x.split(":") for x in PRODUCT[7:-1].split(",")]
    value = lambda k: f[k] if isinstance(f.get(k), Column) else F.lit(f.get(k))
    return F.struct(*[value(k).cast(t).alias(k) for k, t in kinds])


def with_cards(offers: DataFrame, now: Column) -> DataFrame:
    """``offers`` with ``card``.

    Needs provider, city, source_url, timestamp, locality_id and the facts of an offer;
    promotion_name, promotion_description, promotion_duration, legal_notes and equipment
    may be missing. ``now`` stands for a timestamp that is none.
    """
    have = set(offers.columns)
    opt = lambda c, t="string": F.col(c).cast(t) if c in have else F.lit(None).cast(t)
    none = F.array().cast("array<string>")
    ident = F.concat_ws("\0", *[F.coalesce(c, F.lit("None")) for c in (F.col("provider"), F.col("city"), F.col("name"), F.col("internet_speed_mbps").cast("string"), F.col("tv_channels").cast("string"), F.col("mobile_minutes").cast("string"))])
    d = offers.withColumn("__sha", F.sha1(ident)).withColumn("__ident", ident)
    speed, tech = F.col("internet_speed_mbps"), F.col("technology")
    own = F.transform(F.coalesce("services", none), lambda s: F.lower(s))
    inferred = F.filter(
        F.concat(
            F.when(speed.isNotNull() & ~F.array_contains(own, "internet"), F.array(F.lit("internet"))).otherwise(none), own,
            F.when(F.col("tv_channels").isNotNull(), F.array(F.lit("tv"))).otherwise(none),
            F.when(F.col("mobile_minutes").isNotNull() | F.col("mobile_data_gb").isNotNull(), F.array(F.lit("mobile"))).otherwise(none),
        ),
        lambda s: s != "",
    )
    d = d.withColumn("__s", F.array_distinct(inferred)).withColumn("__s", F.when(F.size("__s") > 0, F.col("__s")).otherwise(F.array(F.lit("internet"))))
    main = F.when(
        speed.isNotNull() | F.array_contains(own, "internet"),
        _product(
            code="Main_Internet_service", productCode="SHPD", priority=1, title="Безлимитный интернет", v=1, speedVal=speed, codeTechnology=F.upper(tech), id=F.substring("__sha", 9, 8),
            name=F.when(speed.isNotNull(), F.concat(_shown(speed), F.lit(" Мбит/с"))).otherwise("Домашний интернет"), desc=tech, iconText=speed,
        ),
    )
    fixed = F.array(
        main,
        F.when(F.col("tv_channels").isNotNull(), _product(code="tv_channels", productCode="IPTV", priority=2, v=F.col("tv_channels"))),
        F.when(F.col("mobile_data_gb").isNotNull(), _product(code="mobile_data", productCode="MOBILE", priority=2, v=F.col("mobile_data_gb"), unit="GB")),
        F.when(F.col("mobile_minutes").isNotNull(), _product(code="mobile_minutes", productCode="MOBILE", priority=3, v=F.col("mobile_minutes"))),
    )
    tools = F.transform(F.array_distinct(F.coalesce(opt("equipment", "array<string>"), none)), lambda x, i: _product(code="equipment", productCode="EQUIPMENT", priority=(i + 10), name=x))
    d = d.withColumn("__products", F.array_compact(F.concat(fixed, tools)))
    promo, about, until = opt("promotion_name"), opt("promotion_description"), opt("promotion_duration")
    has_promo = (F.coalesce(promo, F.lit("")) != "") | (F.coalesce(about, F.lit("")) != "")
    title = F.coalesce(T.present(promo), F.lit("Акция"))
    theme = F.lit("gradient-border")
    stock = F.when(
        has_promo,
        F.struct(
            F.lit(True).alias("isStock"), title.alias("stockName"), theme.alias("stockTheme"), about.alias("stockDesc"), until.alias("stockBtnText"), about.alias("discountDesc"),
            T.discount_value(F.col("price_old"), F.col("price")).alias("discountValue"), promo.alias("discountName"), until.alias("discountTextValue"),
        ),
    )
    tabs = F.when(has_promo, F.array(F.struct(F.lit("STOCK").alias("code"), title.alias("name"), theme.alias("theme"), about.alias("desc")))).otherwise(F.array().cast("array<struct<code:string,name:string,theme:string,desc:string>>"))
    number = F.conv(F.substring("__sha", 1, 14), 16, 10).cast("long")
    legal = F.concat(F.array_distinct(F.coalesce(opt("legal_notes", "array<string>"), none)), F.array(F.concat(F.lit("Источник: "), F.col("source_url"))))
    at = F.coalesce(F.try_to_timestamp("timestamp"), now)
    card = F.struct(
        F.col("name"), number.alias("offerId"), F.substring("__sha", 1, 8).alias("id"), F.col("price"), F.col("price_old"), F.lit(0).alias("atoPrice"), T.period(F.col("price_period")).alias("pricePeriod"),
        F.lit(0).alias("orderBuyPrice"), F.col("connection_cost").alias("costConnection"), tech.alias("tech"), F.when(F.size("__s") > 1, "ALLINONE").otherwise("INTERNET").alias("landscape"),
        F.array_join(F.transform("__s", F.initcap), ",").alias("packagesTypes"), F.lit("internet").alias("pts"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created"),
        F.sha1(F.concat(F.col("__ident"), F.lit("\0order"))).alias("orderHash"), F.col("locality_id").alias("localityId"), stock.alias("stockData"), F.col("__products").alias("products"), tabs.alias("tabs"),
        F.lit(1).alias("pocV2"), F.lit("active").alias("lcs"), F.array(F.struct(number.alias("offerId"), F.col("name").alias("title"), legal.alias("items"))).alias("legals"), F.size("__products").alias("pcs"),
    )
    return d.withColumn("card", card).select(*offers.columns, "card")


def cluster_offers(offers: DataFrame, key: str, order: str) -> DataFrame:
    """One offer for each name and set of facts of a record: the best priced and best evidenced one, with the cluster's price range where it is a promotion.

    Names shared by several clusters get their facts behind them.
    """
    name = F.lower(F.trim(F.regexp_replace("name", r"(?U)\s+", " ")))
    pair = F.array_sort(F.array_compact(F.array("price", "price_old")))
    facts = ["internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb"]
    valid = F.col("price").isNotNull() & (F.col("price_old").isNull() | (F.col("price") <= F.col("price_old")))
    rank = F.struct(valid.cast("int"), F.col("price").isNotNull().cast("int"), F.size(F.coalesce("evidence", F.array().cast("array<string>"))), -F.col(order))
    row = F.struct(*offers.columns)
    got = offers.groupBy(key, name.alias("__n"), F.to_json(F.struct(pair.alias("p"), *facts)).alias("__f")).agg(
        F.max_by(row, rank).alias("o"), F.least(F.min("price"), F.min("price_old")).alias("lo"), F.greatest(F.max("price"), F.max("price_old")).alias("hi"),
        F.max(F.coalesce("promotion_name", "promotion_duration").isNotNull()).alias("promo"),
    )
    from pyspark.sql import Window

    got = got.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy(key, "__n")) > 1)
    ranged = F.col("promo") & (F.col("lo") < F.col("hi"))
    price = F.when(ranged, F.col("lo")).otherwise(F.least("o.price", F.coalesce("o.price_old", "o.price")))
    old = F.when(ranged, F.col("hi")).when(F.col("o.price") > F.col("o.price_old"), F.col("o.price")).otherwise(F.col("o.price_old"))
    told = F.array_join(F.array_compact(F.array(F.concat(_shown(F.col("o.internet_speed_mbps")), F.lit(" Мбит/с")), F.concat(F.col("o.tv_channels").cast("string"), F.lit(" ТВ-каналов")), F.concat(F.col("o.mobile_minutes").cast("string"), F.lit(" мин")))), ", ")
    named = F.when(F.col("many") & (told != ""), F.concat(F.col("o.name"), F.lit(" — "), told)).otherwise(F.col("o.name"))
    new = {"price": price, "price_old": old, "name": named}
    return got.select(*[new.get(c, F.col(f"o.{c}")).alias(c) for c in offers.columns])
