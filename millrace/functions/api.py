"""Catalogue API responses as VARIANT expressions: kinds, items, variants and their facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T
from . import tree as J
from .tree import is_list, is_object

# Where lists of items stand, features and parameters that carry allowances.
LIST_KEYS = ["list", "items", "offers", "tariffs", "data", "result"]
LIST_DEPTH = 32
FACT_DDL = (
    "struct<name:string,variant_id:string,price:double,price_old:double,price_period:string,connection_cost:double,technology:string,"
    "internet_speed_mbps:double,tv_channels:int,mobile_minutes:int,mobile_data_gb:double,services:array<string>,conditions:array<string>,"
    "optional_services:array<string>,billing_variants:array<struct<type:string,price:double,price_old:double,price_period:string,"
    "conditions:string,prepaid_months:int,upfront_price:double,monthly_equivalent:double>>>"
)


def parse(payload: Column) -> Column:
    return F.try_parse_json(payload)


def get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def text_of(v: Column, path: str) -> Column:
    return get(v, path, "string")


def number_of(v: Column, path: str) -> Column:
    """A number, or the first one in a text; never a boolean."""
    x = get(v, path)
    kind = F.schema_of_variant(x)
    return F.when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), get(v, path, "double")).when(kind == "STRING", T.number(get(v, path, "string")))


def first_field(v: Column, keys: list[str], kind: str = "variant") -> Column:
    """The first of the keys that holds something: no null, empty text, list or object."""
    full = lambda k: ~F.coalesce(F.to_json(get(v, f"$.{k}")).isin("null", '""', "[]", "{}"), F.lit(True))
    return F.coalesce(*[F.when(full(k), get(v, f"$.{k}", kind)) for k in keys])


def truthy(v: Column, path: str) -> Column:
    """Whether a field holds something: no null, false, zero, empty text, list or object."""
    x = get(v, path)
    s = F.to_json(x)
    return F.coalesce(~s.isin("null", "false", "0", '""', "[]", "{}"), F.lit(False))


def items(v: Column) -> Column:
    """The items of a catalogue, as an array of variants."""
    none = F.array().cast("array<variant>")

    def tariffs(b):
        t = get(b, "$.data.tariffs")
        groups = F.when(is_list(t), F.array(t)).otherwise(F.map_values(F.try_variant_get(t, "$", "map<string,variant>")))
        return F.flatten(F.transform(F.filter(groups, is_list), lambda g: F.try_variant_get(g, "$", "array<variant>")))

    def of_blocks(blocks: Column) -> Column:
        catalog = F.filter(blocks, lambda b: text_of(b, "$.alias") == "catalog")
        return F.flatten(F.transform(catalog, lambda b: F.coalesce(tariffs(b), none)))

    # Bound, so that the response is parsed, and its lists are read, once.
    def read(x: Column) -> Column:
        lists = F.struct(get(x, "$.blocks", "array<variant>").alias("blocks"), J.elements(x).alias("own"))
        return T.let(lists, lambda y: F.when(y["blocks"].isNotNull(), F.filter(of_blocks(y["blocks"]), is_object)).when(y["own"].isNotNull(), F.filter(y["own"], is_object)).otherwise(J.first_list(x, LIST_KEYS, LIST_DEPTH)))

    return F.coalesce(T.let(v, read), none)


def kind(v: Column) -> Column:
    """Which catalogue an item, or a slider variant of one, comes from; null for a flat item."""

    def own(x: Column) -> Column:
        return (
            F.when(is_object(get(x, "$.wifire_tariff")) & get(x, "$.speed_option").isNotNull(), "wifire")
            .when(is_object(get(x, "$.totalPrice")) & get(x, "$.productFeatureGroups").isNotNull(), "mts")
            .when(is_object(get(x, "$.price")) & get(x, "$.parameters").isNotNull() & get(x, "$.tariffType").isNotNull(), "beeline")
        )

    return F.coalesce(F.when(is_object(get(v, "$.offer")) & is_object(get(v, "$.internet_option")), own(get(v, "$.offer"))), own(v))


def variants(item: Column) -> Column:
    """A slider item gives one (item, option) for each option, any other itself."""
    options = get(item, "$.internetOptions", "array<variant>")
    nothing = F.lit(None).cast("variant")
    slider = (kind(item) == "mts") & (F.size(options) > 0)
    pair = lambda o: F.struct(item.alias("item"), o.alias("option"))
    return F.when(F.coalesce(slider, F.lit(False)), F.transform(options, pair)).otherwise(F.array(pair(nothing)))


def _bill(kind_: str, price: Column, period: Column, old: Column | None = None, conditions: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind_).alias("type"), price.alias("price"), (F.lit(None).cast("double") if old is None else old).alias("price_old"), period.alias("price_period"),
        (F.lit(None).cast("string") if conditions is None else conditions).alias("conditions"), F.lit(None).cast("int").alias("prepaid_months"),
        F.lit(None).cast("double").alias("upfront_price"), F.lit(None).cast("double").alias("monthly_equivalent"),
    )


def _some(*values: Column) -> Column:
    return F.filter(F.array(*values), lambda x: x.isNotNull())


def _strings(v: Column, path: str) -> Column:
    return F.coalesce(F.filter(F.transform(get(v, path, "array<variant>"), lambda b: text_of(b, "$.title")), lambda x: F.coalesce(x, F.lit("")) != ""), F.array().cast("array<string>"))


def _facts(**f: Column) -> Column:
    names = ["name", "variant_id", "price", "price_old", "price_period", "connection_cost", "technology", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb", "services", "conditions", "optional_services", "billing_variants"]
    missing = {"services": "array()", "conditions": "array()", "optional_services": "array()", "billing_variants": "array()"}
    return F.struct(*[(f[n] if n in f else F.expr(missing.get(n, "null"))).alias(n) for n in names]).cast(FACT_DDL)


def _monthly(v: Column, path: str) -> Column:
    return F.when(text_of(v, path) == "monthly", "мес")


def slider_facts(item: Column, option: Column) -> Column:
    """Cards with a total price, feature groups and perhaps a speed slider."""
    pick = lambda path, kind_="variant": F.when(option.isNotNull(), get(option, path, kind_)).otherwise(get(item, path, kind_))
    price = pick("$.totalPrice")
    speed = F.when(option.isNotNull(), get(option, "$.internetSpeed")).otherwise(get(item, "$.internetTariff.speed"))
    tv = get(item, "$.tvPackage")
    groups = F.filter(get(item, "$.productFeatureGroups", "array<variant>"), lambda g: text_of(g, "$.groupType") == "Mobile")
    features = F.coalesce(F.flatten(F.transform(groups, lambda g: F.coalesce(get(g, "$.features", "array<variant>"), F.array().cast("array<variant>")))), F.array().cast("array<variant>"))
    free = lambda x: truthy(x, "$.isUnlimited") | (number_of(x, "$.numValue").isNull() & truthy(x, "$.value"))
    told = F.transform(F.filter(features, free), lambda x: F.coalesce(T.present(text_of(x, "$.value")), T.present(text_of(x, "$.title")), text_of(x, "$.baseParameter")))

    def allowance(code: str) -> Column:
        mine = F.filter(features, lambda x: ~free(x) & (text_of(x, "$.baseParameter") == code))
        return F.try_element_at(F.transform(mine, lambda x: number_of(x, "$.numValue")), F.lit(-1))

    has_tv, has_speed = F.coalesce(F.to_json(tv) != "{}", F.lit(False)) & is_object(tv), is_object(speed) & (F.to_json(speed) != "{}")
    note = T.present(F.when(option.isNotNull(), text_of(option, "$.subscriptionFeeAnnotation")).otherwise(text_of(item, "$.subscriptionFeeAnnotation")))
    fee = lambda name: F.when(number_of(pick(f"$.{name}"), "$.numValue").isNotNull(), _bill(name, number_of(pick(f"$.{name}"), "$.numValue"), _monthly(pick(f"$.{name}"), "$.quotaPeriod")))
    value = number_of(speed, "$.numValue")
    badges = F.concat(_strings(price, "$.badges"), _strings(option, "$.offerTotalPrice.badges"))
    return _facts(
        name=T.clean(F.coalesce(T.present(text_of(item, "$.titleForCard")), text_of(item, "$.title"))),
        variant_id=text_of(option, "$.id"),
        price=number_of(price, "$.value"),
        price_old=number_of(price, "$.oldValue"),
        price_period=_monthly(price, "$.unit.quotaPeriod"),
        connection_cost=number_of(item, "$.connectionFee.value"),
        internet_speed_mbps=F.when(text_of(speed, "$.quotaUnit") == "gbit", value * 1000).otherwise(value),
        tv_channels=F.when(has_tv, number_of(tv, "$.channelsCount")).cast("int"),
        mobile_minutes=allowance("MinutesPackage").cast("int"),
        mobile_data_gb=allowance("InternetPackage"),
        services=F.array_distinct(_some(F.when(has_speed, F.lit("internet")), F.when(has_tv, F.lit("tv")), F.when(truthy(item, "$.phoneTariff"), F.lit("phone")), F.when(F.size(groups) > 0, F.lit("mobile")))),
        conditions=F.array_distinct(F.concat(told, _some(note), badges)),
        billing_variants=_some(fee("subscriptionFee"), fee("discountFee")),
    )


def parameter_facts(item: Column) -> Column:
    """Cards with a fee and a list of named parameters."""
    params = F.coalesce(get(item, "$.parameters", "array<variant>"), F.array().cast("array<variant>"))
    mobile = F.coalesce(get(item, "$.mobileParams", "array<variant>"), F.array().cast("array<variant>"))
    named = lambda arr, *codes: F.filter(arr, lambda p: text_of(p, "$.name").isin(*codes))
    last = lambda arr: F.try_element_at(F.transform(arr, lambda p: number_of(p, "$.value")), F.lit(-1))
    included = truthy(item, "$.mobileTariffTitle")
    price, old = number_of(item, "$.price.fee"), number_of(item, "$.price.oldFee")
    period = F.when(F.contains(text_of(item, "$.price.feeUnit"), F.lit("мес")), "мес")

    def told(p):
        code = text_of(p, "$.name")
        more = F.trim(F.concat(code, F.lit(": +"), F.coalesce(text_of(p, "$.value"), F.lit("")), F.lit(" "), F.coalesce(text_of(p, "$.unit"), F.lit(""))))
        return F.when(truthy(p, "$.isUnlimited"), F.concat(code, F.lit(": безлимит"))).when(code.isin("AdditionalPackageGb", "AdditionalPackageMin"), more)

    limited = F.filter(mobile, lambda p: ~truthy(p, "$.isUnlimited"))
    kinds = F.transform(F.filter(params, lambda p: text_of(p, "$.name").isin("speed", "channels", "kinopoisk")), lambda p: F.when(text_of(p, "$.name") == "speed", "internet").otherwise("tv"))
    return _facts(
        name=T.clean(F.coalesce(T.present(text_of(item, "$.tariffName")), T.present(text_of(item, "$.mobileTariffTitle")), text_of(item, "$.title"))),
        price=price,
        price_old=F.when((old > 0) & (price.isNull() | (old >= price)), old),
        price_period=period,
        internet_speed_mbps=last(named(params, "speed")),
        tv_channels=last(named(params, "channels", "kinopoisk")).cast("int"),
        mobile_minutes=F.when(included, last(named(limited, "MinutePackage"))).cast("int"),
        mobile_data_gb=F.when(included, last(named(limited, "InternetPackage"))),
        services=F.array_distinct(F.concat(kinds, _some(F.when(included, F.lit("mobile"))))),
        conditions=F.concat(_some(T.present(text_of(item, "$.price.promo"))), F.filter(F.transform(mobile, told), lambda x: x.isNotNull())),
        optional_services=_some(
            F.when(~included & (F.size(mobile) > 0), F.lit("Подарочная SIM: условия и последующая плата в raw_offer.mobileParams")),
            F.when(truthy(item, "$.yandexPrice"), F.lit("Яндекс Плюс")),
        ),
        billing_variants=_some(F.when(truthy(item, "$.yandexPrice"), _bill("yandexPrice", number_of(item, "$.yandexPrice.fee"), period, number_of(item, "$.yandexPrice.oldFee"), text_of(item, "$.yandexPrice.promo")))),
    )


def embedded_price(base, extra, increment, percent, bundle, house, has_sale, scope, house_price) -> tuple[Column, Column]:
    """(price, old price before comparison) of an embedded tariff's variant."""
    old = F.when(~bundle, F.when(house, house_price).otherwise(base)).otherwise(base + F.when(house, extra).otherwise(increment))
    total = base + increment + extra
    plain = F.when(house | ~has_sale, old).otherwise(old * (1 - percent / 100))
    sold = F.when(scope == "dominet", base).when(scope == "", total).otherwise(F.ceil(total - F.floor(total * percent / 100 + 0.5)).cast("double"))
    return F.when(~bundle, plain).when(house, old).when(has_sale, sold).otherwise(base + increment), old


def embedded_facts(source: Column) -> Column:
    """Tariffs from a page's embedded data: price, option, house and sale arithmetic."""
    item = get(source, "$.wifire_tariff")
    options = F.map_filter(F.try_variant_get(get(item, "$.di_options"), "$", "map<string,variant>"), lambda k, v: ~F.coalesce(F.to_json(v).isin('""', "null"), F.lit(True)))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    shown = lambda c: F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
    fields = F.struct(
        (text_of(source, "$.house_type") == "house").alias("house"), text_of(source, "$.speed_option").alias("option"), options.alias("options"), zero(number_of(item, "$.price")).alias("base"),
        zero(number_of(item, "$.di_priceOwnHouse")).alias("extra"), zero(number_of(item, "$.sale.sale")).alias("percent"), truthy(item, "$.sale.text").alias("has_sale"), text_of(item, "$.sale.scope").alias("scope"),
        number_of(item, "$.priceOwnHouse").alias("house_price"), zero(number_of(item, "$.tvchan")).alias("channels"), number_of(item, "$.inet").alias("data"), number_of(item, "$.mobile_inet").alias("bonus"),
    )

    def chosen(x: Column) -> Column:
        increment = zero(number_of(F.try_element_at(x["options"], x["option"]), "$"))
        return T.let(F.struct(x.alias("x"), F.coalesce(F.size(x["options"]) > 0, F.lit(False)).alias("bundle"), increment.alias("increment")), priced)

    def priced(y: Column) -> Column:
        x = y["x"]
        price, old = embedded_price(x["base"], x["extra"], y["increment"], x["percent"], y["bundle"], x["house"], x["has_sale"], x["scope"], x["house_price"])
        return T.let(F.struct(x.alias("x"), y["bundle"].alias("bundle"), price.alias("price"), old.alias("old")), told)

    def told(p: Column) -> Column:
        x, bundle, price, old = p["x"], p["bundle"], p["price"], p["old"]
        house, option, has_sale, channels, data, bonus = (x[c] for c in ("house", "option", "has_sale", "channels", "data", "bonus"))
        sale = F.concat(F.lit("Скидка "), text_of(item, "$.sale.text"), F.lit(": "), F.coalesce(text_of(item, "$.sale.duration"), F.lit("")), F.lit("; "), F.coalesce(text_of(item, "$.sale.date"), F.lit("")))
        unlimited = bundle & (data == 999)
        return _facts(
            name=T.repair_mojibake(F.coalesce(T.present(text_of(item, "$.name")), text_of(source, "$.tariff_id"))),
            variant_id=F.concat_ws(":", text_of(source, "$.tariff_id"), text_of(source, "$.house_type"), option),
            price=price,
            price_old=F.when(old > price, old),
            price_period=F.lit("мес"),
            connection_cost=number_of(item, "$.connection_fee"),
            internet_speed_mbps=T.number(F.substring_index(option, "_", 1)),
            tv_channels=F.when((channels != 0) & ~bundle, channels).cast("int"),
            mobile_minutes=F.when(bundle, number_of(item, "$.minutes")).cast("int"),
            mobile_data_gb=F.when(bundle & ~F.coalesce(unlimited, F.lit(False)), data),
            services=_some(F.lit("internet"), F.when((channels != 0) & ~bundle, F.lit("tv")), F.when(bundle, F.lit("mobile"))),
            conditions=_some(
                F.when(house, F.lit("Тип подключения: частный дом")).otherwise("Тип подключения: квартира"),
                F.when(has_sale & ~house, T.repair_mojibake(sale)),
                F.when(unlimited, F.lit("Безлимитный мобильный интернет")),
                F.when(~bundle & (bonus != 0), F.concat(F.lit("Бонусный мобильный интернет: "), shown(bonus), F.lit(" ГБ к основному тарифу"))),
            ),
            optional_services=_some(F.when((channels != 0) & bundle, F.concat(F.lit("Телевидение: доступно "), shown(channels), F.lit(" каналов; подключение за отдельную плату")))),
        )

    return T.let(fields, chosen)


def flat_facts(item: Column) -> Column:
    """Items whose keys are the facts themselves, some under older names."""
    either = lambda f, a, b: F.coalesce(f(item, f"$.{a}"), f(item, f"$.{b}"))
    services = F.transform(F.coalesce(get(item, "$.services", "array<string>"), F.array().cast("array<string>")), T.service)
    return _facts(
        name=T.present(text_of(item, "$.name")),
        price=number_of(item, "$.price"),
        price_old=number_of(item, "$.price_old"),
        price_period=either(text_of, "price_period", "pricePeriod"),
        connection_cost=either(number_of, "connection_cost", "costConnection"),
        technology=T.technology(either(text_of, "technology", "tech")),
        internet_speed_mbps=either(number_of, "internet_speed_mbps", "speedVal"),
        tv_channels=number_of(item, "$.tv_channels").cast("int"),
        mobile_minutes=number_of(item, "$.mobile_minutes").cast("int"),
        mobile_data_gb=number_of(item, "$.mobile_data_gb"),
        services=F.array_distinct(F.filter(services, lambda x: x.isNotNull())),
    )


def facts(item: Column, option: Column) -> Column:
    """The facts of an item by its kind."""
    k = kind(item)
    return F.when(k == "wifire", embedded_facts(item)).when(k == "mts", slider_facts(item, option)).when(k == "beeline", parameter_facts(item)).otherwise(flat_facts(item))
