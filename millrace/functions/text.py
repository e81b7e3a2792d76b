"""Scalar functions over text as Column expressions: numbers, prices, speeds, names, identities.

All of them stay in the JVM. Patterns begin with ``(?iuU)`` where letters may be
Cyrillic: Java matches them case-insensitively, and as word characters, only then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number, price, speed and label patterns, service words and periods.
NUMBER = r"-?\d+(?:[\s ]\d{3})*(?:[.,]\d+)?"
AMOUNT = r"((?:\d{1,3}(?:[ \t ]\d{3})+|\d{1,8})(?:[.,]\d+)?)"
CURRENCY = r"(?:₽|руб(?:\.|лей)?|р\.?)"
MONTHLY = r"(?iuU)(?<!\d)" + AMOUNT + r"[ \t⁠]*" + CURRENCY + r"[ \t⁠]*(?:/|в[ \t⁠]+)?[ \t⁠]*(?:мес|месяц)"
YEARLY = r"(?iuU)(?<!\d)(\d[\d  ]{0,8}(?:[.,]\d+)?)\s*(?:₽|руб\.?)\s*/\s*год\b"
ANCILLARY = r"(?iuU)(?:роутер|маршрутизатор|оборудован|приставк|аренд|подключ|установ|разов|(?:белый|статическ\w*)\s+ip|ip[-\s]?адрес)"
INCLUDED = r"(?iuU)(?:₽|руб|в\s+составе|включ[её]н|в\s+подарок|бесплатн|подключите)"
CURRENCY_END = r"(?iuU)(?<!\d)" + AMOUNT + r"[ \t ]*" + CURRENCY + r"[*\s]*$"
PERIOD_LINE = r"(?iuU)^(?:/|в\s+)?(?:мес(?:яц)?|month)\.?$"
UNIT_LINE = r"(?iuU)^(?:₽|руб(?:\.|лей)?|р\.?)?\s*/?\s*(?:мес|месяц)\.?$"
BARE_NUMBER = r"^\d{1,8}(?:[.,]\d+)?$"
MONTH_CELL = r"(?iuU)^(\d{2,8}(?:[.,]\d+)?)\s+(?:в\s+)?месяц$"
REVERSED = r"(?iuU)(?:мес(?:яц)?|month)\s+(?:всего\s+|за\s+|for\s+)?(\d+(?:[.,]\d+)?)\s*(?:₽|руб(?:\.|лей)?|rub)"
SCRIPT_SPEED = r"""(?iuU)speed(?:OwnHouse)?[\\"]*\s*:\s*[\\"]*(\d+(?:[.,]\d+)?)"""
SCRIPT_PRICE = r"""(?iuU)price(?:OwnHouse)?[\\"]*\s*:\s*[\\"]*(\d+(?:[.,]\d+)?)"""
SCRIPT_MARK = r"""(?iuU)speed(?:OwnHouse)?[\\"]*\s*:"""
PRICE_SIGN = r"(?iuU)мес|month|price"
DUAL_SPEED = r"(?iuU)(?<!\d)(\d+(?:[.,]\d+)?)\s*/\s*\d+(?:[.,]\d+)?\s*(мбит|гбит|mbps|gbps)"
SPEED = r"(?iuU)(?<!\d)(\d+(?:[.,]\d+)?)\s*(мбит|гбит|mbps|gbps)"
STANDALONE = r"(?iuU)^(\d[\d \t ]{0,8}(?:[.,]\d+)?)(?:\s*(?:₽|руб(?:\.|лей)?))?$"
DISCOUNT = r"(?iuU)(?:скидк|акци|промо|discount|[−–-]\s*\d+\s*%)"
SERVICE_LABELS = ["internet", "tv", "mobile", "phone", "cinema", "gaming", "other"]
SERVICE_WORDS = [
    (["интернет"], "internet"),
    (["тв", "телевид"], "tv"),
    (["мобил", "сим"], "mobile"),
    (["телефон", "звон"], "phone"),
    (["кино", "cinema"], "cinema"),
    (["игр", "gaming"], "gaming"),
]
EXPLICIT_NAME = r"(?iuU)^(?:тариф|подписка|план|offer|plan)\b"
BARE_LABEL = r"(?iuU)^(?:тариф|тарифы|подписка|план|offer|plan)[:\s]*$"
FOR_WHOM = r"(?iuU)^тариф\s+для\s+(?:тех|тех,|того|всех)\b"
NAME_NOISE = (
    r"(?iuU)^(?:тарифы\b|акци|старт\s+на\b|изображение\b|домашн|скорост|над[её]ж|пакет|хит\s+продаж|до\s+\d|защит|вс[её]\s+включено|"
    r"для\s+дома|интернет\s*\+|мобильн|сим\b|(?:\d+\s+)?мегасил|безлимит$|полный\s+безлимит|родительск|блокировк|"
    r"группа\s+для|скидк|новинк|выберите\s+тариф|подключить$|хотите\s+смотреть|инсис\s+тв|"
    r"характеристики?$|скорость:?$|в\s+месяц$|абонентская\s+плата|[-−–]?\d+\s*%)"
)
MEASURED = r"(?iuU)\d.*(?:₽|руб|р\s*/|мбит|гбит|gb|гб|мин|канал)"
OPTIONAL_LINE = r"(?iuU)^(?:Можно\s+добавить|Оплата\s+за\s+цифровое|К\s+любому\s+тарифу\s+доступ)"
CONDITION_LINE = r"(?iuU)(?:при\s+активации|скидк.*(?:месяц|мес)|акци.*(?:месяц|адрес)|ограниченн.*адрес|безлимитный\s+мобильный)"


def _lit(pattern: str) -> Column:
    return F.lit(pattern)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is in the plan, and computed, once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def plain_double(c: Column) -> Column:
    """A number's text without grouping blanks, comma as point; null where that is no number."""
    return F.expr("1") if c is None else F.translate(c, ",  \t", ".").try_cast("double")


def number(c: Column) -> Column:
    """The first number in a text, as a double."""
    return plain_double(F.nullif(F.regexp_extract(c, NUMBER, 0), F.lit("")))


def integer(c: Column) -> Column:
    """The first number in a text, cut to an integer."""
    return number(c).try_cast("int")


def clean(c: Column) -> Column:
    """White space collapsed and trimmed; null for nothing."""
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def folded(c: Column) -> Column:
    """Collapsed, trimmed and lower-cased."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def present(c: Column) -> Column:
    """Trimmed text, null for nothing."""
    return F.nullif(F.trim(c), F.lit(""))


def lines(block: Column) -> Column:
    """Trimmed lines that hold something."""
    return F.filter(F.transform(F.split(block, r"\r\n|\n|\r"), lambda x: F.trim(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))), lambda x: x != "")


def doubles(found: Column) -> Column:
    """Numbers of an array of texts; those that are none are left out."""
    return F.filter(F.transform(found, plain_double), lambda x: x.isNotNull())


def first_with(items: Column, *terms: str) -> Column:
    """The first text that contains one of the terms, regardless of case; without terms the first that isn't empty."""
    low = [t.lower() for t in terms]
    hit = lambda x: F.exists(F.lit(low), lambda t: F.contains(F.lower(x), t)) if low else x != ""
    return F.get(F.filter(items, hit), F.lit(0))


def evidence_fragment(payload: Column, needle: Column, radius: int = 100) -> Column:
    """The payload's stretch around the needle, regardless of case; empty where it isn't found."""
    n = F.trim(needle)
    at = F.position(F.lower(n), F.lower(payload))
    begin = F.greatest(F.lit(1), at - radius)
    part = F.substr(payload, begin, (at - begin) + F.length(n) + radius)
    return F.when((F.coalesce(n, F.lit("")) == "") | (F.coalesce(at, F.lit(0)) == 0), F.lit("")).otherwise(F.substring(F.trim(part), 1, 280))


def service(c: Column) -> Column:
    """One service label of a text; null for nothing."""
    v = F.lower(F.trim(c))
    out = F.when(v == "", F.lit(None).cast("string")).when(v.isin(SERVICE_LABELS), v)
    for marks, label in SERVICE_WORDS:
        hit = F.lit(False)
        for m in marks:
            hit = hit | F.contains(v, F.lit(m))
        out = out.when(hit, F.lit(label))
    return out.when(v.isNotNull(), F.lit("other"))


def services(items: Column) -> Column:
    """Distinct labels in the order of their first mention."""
    return F.array_distinct(F.filter(F.transform(items, service), lambda x: x.isNotNull()))


def technology(c: Column) -> Column:
    """A technology's name; null where it is a speed."""
    return F.when(~F.lower(c).rlike("мбит|гбит|mbps|gbps"), c)


def period(c: Column) -> Column:
    """Billing period as cards show it."""
    v = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return (
        F.when(v == "", "мес").when(F.contains(v, F.lit("мес")), "мес").when(F.contains(v, F.lit("день")) | F.contains(v, F.lit("сут")), "день").otherwise(c)
    )


def discount_value(old: Column, price: Column) -> Column:
    """Percent by which the price is below the old one."""
    return F.when((old > 0) & price.isNotNull(), F.round((old - price) / old * 100, 1))


def normalized_path(url: Column) -> Column:
    """A URL's path with slugs, ids and numbers replaced."""
    p = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    p = F.regexp_replace(p, r"/-[^/]+-(?=/|$)", "/:slug")
    p = F.regexp_replace(p, r"/[0-9a-f-]{8,}", "/:id")
    p = F.regexp_replace(p, r"/\d+", "/:n")
    p = F.regexp_replace(p, r"/+$", "")
    return F.when(p == "", "/").otherwise(p)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def domain(url: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host(url), ".", -2)


def shape(c: Column, city: Column | None = None) -> Column:
    """A text's form: digits as #, white space collapsed, lower case, 120 characters at most."""
    if city is not None:
        quoted = F.concat(F.lit("(?iuU)\\Q"), F.replace(city, F.lit("\\E"), F.lit("")), F.lit("\\E"))
        c = F.when(F.coalesce(city, F.lit("")) != "", F.regexp_replace(c, quoted, F.lit("<city>"))).otherwise(c)
    v = F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"\d+", "#")
    return F.substring(F.lower(F.trim(v)), 1, 120)


def size_bucket(payload: Column) -> Column:
    return F.least(F.floor(F.length(payload) / 100_000), F.lit(15)).cast("int")


def _marks(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as Latin-1 put right, up to twice, while the marks of it become fewer."""

    def better(x: Column, back: Column) -> Column:
        fewer = x.rlike("[ÐÑÃÂ]") & F.is_valid_utf8(back) & (_marks(back, "ÐÑÃ") < _marks(x, "ÐÑÃ"))
        return F.when(fewer, back).otherwise(x)

    def once(x: Column) -> Column:
        latin = F.when(x.rlike(r"^[\x00-\xFF]*$"), x)
        return let(F.encode(latin, "ISO-8859-1").cast("string"), lambda back: better(x, back))

    return let(let(c, once), once)


def safe_name(c: Column, size: int = 100) -> Column:
    """A file-system name."""
    v = F.regexp_replace(F.trim(c), r'[<>:"/\\|?*\x00-\x1F]+', "_")
    return F.coalesce(F.nullif(F.substring(v, 1, size), F.lit("")), F.lit("unknown"))


def record_id(provider: Column, city: Column, region: Column, url: Column, timestamp: Column) -> Column:
    parts = [F.coalesce(x, F.lit("")) for x in (provider, city, region, url, timestamp)]
    return F.substring(F.sha2(F.concat_ws("\0", *parts), 256), 1, 24)


def offer_number(*parts: Column) -> Column:
    """A card's integer id: the first 14 hex digits of a SHA-1."""
    return F.conv(F.substring(F.sha1(F.concat_ws("\0", *parts)), 1, 14), 16, 10).cast("long")


def numbers_in(c: Column) -> Column:
    """Distinct stand-alone numbers of a text."""
    found = F.regexp_extract_all(c, _lit(r"(?<!\d)(\d+(?:[  ]\d{3})*(?:[.,]\d+)?)(?!\d)"), F.lit(1))
    return F.array_distinct(doubles(found))


def number_in_text(value: Column, c: Column) -> Column:
    """Whether the value stands in the text, as no part of a longer number."""
    shown = F.when(value == F.floor(value), value.cast("long").cast("string")).otherwise(value.cast("string"))
    return F.regexp_like(c, F.concat(F.lit(r"(?<!\d)"), F.replace(shown, F.lit("."), F.lit("[.,]")), F.lit(r"(?!\d)")))


def speeds(block: Column) -> Column:
    """Speeds in Mbit/s: first those written as a pair, then all, then those of scripts."""

    def scaled(pattern: str) -> Column:
        values, units = (F.regexp_extract_all(block, _lit(pattern), F.lit(i)) for i in (1, 2))
        both = F.arrays_zip(values.alias("v"), units.alias("u"))
        return F.transform(both, lambda z: plain_double(z["v"]) * F.when(F.lower(z["u"]).isin("гбит", "gbps"), 1000.0).otherwise(1.0))

    seen = F.concat(scaled(DUAL_SPEED), scaled(SPEED))
    script = F.array_distinct(doubles(F.regexp_extract_all(block, _lit(SCRIPT_SPEED), F.lit(1))))
    return F.concat(seen, F.array_except(script, seen))


def yearly_prices(block: Column) -> Column:
    return doubles(F.regexp_extract_all(block, _lit(YEARLY), F.lit(1)))


def monthly_prices(block: Column) -> Column:
    """Recurring monthly prices of a block, in the order of their rules.

    Amounts of a line about equipment or fees, or below such a line, don't count. Then
    come amounts whose period stands on another line, bare month cells beside a speed,
    "month for N" phrases, and script fields.
    """
    empty = F.array().cast("array<double>")

    def amount(x):
        parsed = plain_double(x)
        # "695 645": an old and a current price, not thousands.
        last = plain_double(F.element_at(F.split(x, r"[ \t ]+"), -1))
        return F.when((parsed > 100_000) & x.rlike(r"[ \t ]"), last).otherwise(parsed)

    def of_lines(raw):
        def barred(i):
            above = F.slice(raw, F.greatest(F.lit(1), i - 1), F.least(F.lit(2), i))
            return F.exists(F.when(i > 0, above).otherwise(F.array().cast("array<string>")), lambda x: x.rlike(ANCILLARY) & ~x.rlike(INCLUDED))

        def of_line(x, i):
            fine = x.rlike(MONTHLY) & ~x.rlike(r"(?iuU)^Можно\s+добавить") & ~x.rlike(ANCILLARY) & ~barred(i)
            return F.when(fine, F.transform(F.regexp_extract_all(x, _lit(MONTHLY), F.lit(1)), amount)).otherwise(empty)

        return F.filter(F.flatten(F.transform(raw, of_line)), lambda x: x.isNotNull())

    def of_periods(ls):
        def split_line(x, i):
            money = lambda y: plain_double(F.nullif(F.regexp_extract(y, CURRENCY_END, 1), F.lit("")))
            a = F.when(x.rlike(PERIOD_LINE), F.array(F.coalesce(money(F.get(ls, i - 1)), money(F.get(ls, i - 2)))))
            b = F.when(x.rlike(UNIT_LINE) & F.get(ls, i - 1).rlike(BARE_NUMBER), F.array(plain_double(F.get(ls, i - 1))))
            return F.concat(F.coalesce(a, empty), F.coalesce(b, empty))

        cells = F.filter(ls, lambda x: x.rlike(MONTH_CELL))
        beside = lambda xs: F.when(F.size(xs) == 0, empty).when(F.size(speeds(block)) > 0, F.transform(xs, lambda x: plain_double(F.regexp_extract(x, MONTH_CELL, 1)))).otherwise(empty)
        return F.concat(F.flatten(F.transform(ls, split_line)), let(cells, beside))

    # Bound, so that lines are cut once and not again at each of them.
    def found(first):
        back = doubles(F.regexp_extract_all(block, _lit(REVERSED), F.lit(1)))
        script = F.when(block.rlike(SCRIPT_MARK), doubles(F.regexp_extract_all(block, _lit(SCRIPT_PRICE), F.lit(1)))).otherwise(empty)
        more = F.filter(F.concat(let(lines(block), of_periods), back, script), lambda x: x.isNotNull())
        return F.concat(first, F.array_except(F.array_distinct(more), first))

    # Every rule needs a word for the period or a script's field.
    return F.when(~block.rlike(PRICE_SIGN), empty).otherwise(let(let(F.split(block, "\n"), of_lines), found))


def commercial_name(ls: Column) -> Column:
    """The line that names an offer: an explicit label, a short home tariff, a name with a number, what stands above a discount, the first fit line, the first line."""
    explicit = F.get(F.filter(ls, lambda x: x.rlike(EXPLICIT_NAME) & ~x.rlike(BARE_LABEL) & ~x.rlike(FOR_WHOM)), F.lit(0))

    def fit(x):
        return (
            F.length(x).between(3, 80) & ~x.rlike(NAME_NOISE) & ~x.startswith("[") & ~F.contains(x, F.lit("<")) & ~x.startswith("+")
            & ~x.rlike(r"^\d{4}$") & ~x.rlike(MEASURED)
        )

    fits = F.filter(ls, fit)
    home = F.get(F.filter(fits, lambda x: x.rlike(r"(?iuU)(?:\bдома\b|\bhome\b)") & (F.size(F.split(x, r"(?U)\s+")) <= 4)), F.lit(0))
    brand = F.get(F.filter(fits, lambda x: x.rlike(r"[A-Za-zА-Яа-яЁё].*\d{2,4}") & ~x.rlike(r"(?iuU)антивирус|security")), F.lit(0))
    promo = r"(?iuU)скидк|акци|промо"
    above = F.transform(ls, lambda x, i: F.when((i > 0) & x.rlike(promo) & F.coalesce(F.array_contains(fits, F.get(ls, i - 1)), F.lit(False)), F.get(ls, i - 1)))
    above = F.try_element_at(F.filter(above, lambda x: x.isNotNull()), F.lit(-1))
    return F.coalesce(explicit, home, brand, above, F.get(fits, F.lit(0)), F.get(ls, F.lit(0)), F.lit(""))


def standalone_old_price(ls: Column, current: Column) -> Column:
    """A larger amount alone on a line near the current price: up to three lines above it (nearest first), else up to three below."""
    alone = lambda x: plain_double(F.nullif(F.regexp_extract(x, STANDALONE, 1), F.lit("")))

    def sought(b):
        def at(x, i):
            near = F.coalesce(*[F.get(b["larger"], i - j) for j in (1, 2, 3)], *[F.get(b["larger"], i + j) for j in (1, 2, 3)])
            here = let(F.concat_ws("\n", x, F.get(b["ls"], i + 1)), lambda two: F.array_contains(monthly_prices(two), current))
            # Prices are sought last, and only where an amount is near.
            return F.when(near.isNotNull(), F.when(F.coalesce(here, F.lit(False)), near))

        return F.get(F.filter(F.transform(b["ls"], at), lambda x: x.isNotNull()), F.lit(0))

    def told(b):
        return F.when(F.exists(b["larger"], lambda x: x.isNotNull()), sought(b))

    larger = lambda xs: F.struct(xs.alias("ls"), F.transform(xs, lambda x: let(alone(x), lambda v: F.when(v > current, v))).alias("larger"))
    return let(let(ls, larger), told)
