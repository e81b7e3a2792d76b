"""Scalar functions, catalogue responses, pages, and the main plan on small inputs."""

import json

import pytest
from millrace.functions import api as A
from millrace.functions import html as H
from millrace.functions import text as T
from millrace.operators import compare, sampling
from millrace.plans import normalize as N
from millrace.sources import snapshots as S
from pyspark.sql import functions as F


def values(spark, texts, f):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(f(F.col("x"))).collect()]


def test_numbers(spark):
    assert values(spark, ["от 1 200,50 ₽", "100 200", "нет", None], T.number) == [1200.5, 100200.0, None, None]


def test_monthly_prices(spark):
    cases = {
        "500 руб./мес.": [500], "1 200 ₽ в месяц": [1200], "Аренда роутера\n150 руб/мес": [], "695 645 руб/мес": [645], "390 ₽\nв месяц": [390],
        "100 Мбит/с\n840 месяц": [840], "месяц за 500 ₽": [500], "": [],
    }
    assert values(spark, list(cases), T.monthly_prices) == list(cases.values())


def test_speeds_and_words(spark):
    assert values(spark, ["1 Гбит/с", "100/50 Мбит/с"], T.speeds) == [[1000.0], [100.0, 50.0]]
    row = spark.range(1).select(T.services(F.array(*map(F.lit, ["Домашний интернет", "ТВ", "интернет", "Подписка"]))).alias("s"), T.period(F.lit("в сутки")).alias("p")).first()
    assert row.s == ["internet", "tv", "other"] and row.p == "день"


CARD = {
    "titleForCard": "Дом", "totalPrice": {"value": 500, "oldValue": 700, "unit": {"quotaPeriod": "monthly"}}, "internetTariff": {"speed": {"numValue": 1, "quotaUnit": "gbit"}},
    "tvPackage": {"channelsCount": 200},
    "productFeatureGroups": [{"groupType": "Mobile", "features": [{"baseParameter": "MinutesPackage", "numValue": 300}, {"baseParameter": "InternetPackage", "isUnlimited": True, "value": "Безлимит"}]}],
}


def test_catalogue_facts(spark):
    slider = dict(CARD, internetOptions=[{"id": i, "totalPrice": {"value": i}, "internetSpeed": {"numValue": 100}} for i in (7, 8)])
    d = spark.createDataFrame([(json.dumps([x], ensure_ascii=False),) for x in (CARD, slider)], "p string")
    rows = d.select(F.explode(A.items(A.parse("p"))).alias("i")).select(F.explode(A.variants(F.col("i"))).alias("v")).select(A.slider_facts(F.col("v.item"), F.col("v.option")).alias("f")).collect()
    f = rows[0].f
    assert (f.price, f.price_old, f.price_period, f.internet_speed_mbps, f.tv_channels, f.mobile_minutes, f.mobile_data_gb) == (500, 700, "мес", 1000, 200, 300, None)
    assert f.services == ["internet", "tv", "mobile"] and f.conditions == ["Безлимит"]
    assert [r.f.variant_id for r in rows[1:]] == ["7", "8"]


@pytest.mark.parametrize(("scope", "want"), [("x", 520.0), ("dominet", 500.0), ("", 650.0)])
def test_embedded_prices(spark, scope, want):
    n, b = (lambda v: F.lit(float(v))), F.lit
    price, old = A.embedded_price(n(500), n(50), n(100), n(20), b(True), b(False), b(True), b(scope), n(0))
    assert tuple(spark.range(1).select(price, old).first()) == (want, 600.0)


PAGE = "<html><body><div><h2>Тариф Дома {0}00</h2><p>{0}00 Мбит/с</p><p>{1} руб./мес.</p></div></body></html>"


def test_plan_splits_records(spark):
    rows = [("demo", "Город", f"http://x/{i}", "t", None, PAGE.format(i, 400 + 100 * i)) for i in (1, 2)]
    rows += [("demo", "Город", "http://x/1", "t", None, "again"), ("demo", "Город", "http://x/3", "t", "error", "x"), ("demo", "Город", "http://x/4", "t", "OK", " ")]
    d = spark.createDataFrame(rows, "provider string, city string, url string, timestamp string, status string, html string").coalesce(1)
    got = N.normalize(S.records(d))
    assert [(r.name, r.price, r.internet_speed_mbps) for r in got.offers.orderBy("seq").collect()] == [("Тариф Дома 100", 500.0, 100.0), ("Тариф Дома 200", 600.0, 200.0)]
    assert sorted(r.error for r in got.errors.collect()) == ["empty payload", "source status: error"]
    total = got.stats().where("provider is null").first()
    assert (total.records, total.skipped, total.succeeded, total.failed, total.offers) == (5, 1, 2, 2, 2)


# A card of each kind of page, and its text.
FAMILIES = {
    "rates": (
        '<div class="rates-list-internet__item"><b class="rates-list-internet__item-title">Дом</b><p>до 300 Мбит/с</p><i class="rates-list-internet__item-price">500 ₽ / мес</i><u class="rates-list-internet__item-proposal">аренда роутера 100 ₽</u></div>',
        "[DOM CARD TITLE]\nДом\n500 ₽ / мес\nДом\nдо 300 Мбит/с\n500 ₽ / месаренда роутера 100 ₽\nМожно добавить: аренда роутера 100 ₽",
    ),
    "wrapper": (
        '<div class="card__wrapper"><p class="card-title">Мой дом</p><p>300 Мбит/с</p><p class="price-sale">900</p><p class="price-main">500 ₽/мес</p><div class="m-tariff__options">Кино</div>'
        '<div class="universal-regulator__label"><i class="mm-web-radio__marker"></i>500 минут</div><div class="universal-regulator__label"><i class="mm-web-radio__marker mm-web-radio__marker_selected"></i>300 минут</div></div>',
        "[DOM CARD TITLE]\nМой дом\nАкционный тариф\n900\n500 ₽/мес\nМой дом\n300 Мбит/с\n900\n500 ₽/мес\n300 минут",
    ),
    "catalog": (
        '<div><b class="catalog-carousel-badge__title">Хит</b><div class="catalog-service-card"><p class="catalog-service-card__name">Старт</p><p>100 Мбит/с</p>'
        '<div class="catalog-service-card__linked-products"><i class="catalog-service-card__linked-product">Wink</i></div>'
        '<div class="catalog-service-card__footer"><span class="catalog-price__value">400 ₽</span><span class="catalog-price__original">600 ₽</span></div></div></div>',
        "Старт\nАкционный тариф\n600 ₽\n400 ₽\nХит\nМожно добавить: Wink\nСтарт\n100 Мбит/с\n400 ₽\n600 ₽",
    ),
    "general": (
        '<div class="general-cont" itemtype="http://schema.org/Offer"><p class="name-title">Город</p><p>100 Мбит/с</p><p>450 руб./мес</p></div>',
        "Город\nГород\n100 Мбит/с\n450 руб./мес",
    ),
    "product": (
        '<div itemtype="https://schema.org/Product"><div itemtype="https://schema.org/Product"><meta itemprop="name" content="Пакет"><meta itemprop="price" content="700">'
        '<div itemprop="additionalProperty"><meta itemprop="name" content="internetSpeed"><meta itemprop="value" content="500"></div>'
        '<div class="rate-card_card__x"><p>700 ₽/мес</p><div class="additional-services_wrapperService">Кино</div></div></div></div>',
        "Пакет\n500 Мбит/с\nМожно добавить: Кино\n700 ₽/мес",
    ),
    "tours": (
        '<div class="mkdf-tours-standard-item"><p class="mkdf-tour-title">Тур</p><p>100 Мбит/с</p><span class="mkdf-tours-item-price" style="text-decoration:line-through">900</span><span class="mkdf-tours-item-price">500</span></div>',
        "Тур\nАкционный тариф\n900\n500\nТур\n100 Мбит/с\n900\n500",
    ),
    "headed": (
        '<p class="dopprice"></p><div><b class="nametp">Дом 100</b><i class="prc">500 руб. ____ мес.</i></div><div><b class="nametp">Дом 200</b><i class="prc">700 руб./мес</i></div>',
        "Дом 100\n500 руб./мес|Дом 200\n700 руб./мес",
    ),
    "unspecified": (
        '<div class="m-tariff"><p class="m-tariff__name">Соло</p><p class="m-tariff__speed">100 Мбит/с</p><b class="m-tariff__price-value" data-cost="550">550</b><p class="m-tariff__description">Описание</p><label for="tariff_option_1">Статический адрес</label></div>',
        'Соло\n100 Мбит/с\nОписание\nМожно добавить: Статический адрес\n[UNSPECIFIED BILLING]\nЦена тарифа: 550 ₽\n[SOURCE PRICE] <b class="m-tariff__price-value" data-cost="550">550</b>',
    ),
}


@pytest.mark.parametrize("kind", FAMILIES)
def test_cards_of_every_kind(kind):
    page, want = FAMILIES[kind]
    assert H.dom_cards(f"<html><body>{page}</body></html>") == want.split("|")


def test_cards_of_odd_pages():
    assert H.dom_cards("") == [] and H.dom_cards("<div class=card__wrapper><p class=card-title>x") == []
    outer = f'<div class="card__wrapper">{FAMILIES["wrapper"][0]}</div>'
    assert H.dom_cards(outer) == [FAMILIES["wrapper"][1]]
    assert H.dom_cards('<div class="card__wrapper"><p class="card-title">a</p><span>1 Мбит/с</span><span>Aa</span><span>Bb</span><p class="price-main">5 ₽/мес</p></div>')[0].splitlines()[3:] == ["1 Мбит/с", "Aa", "Bb", "5 ₽/мес"]


def test_visible_text_and_lines():
    page = H.page_of(H.Markup("<title>Т</title><style>x</style><div>Раз<span>два</span><svg><p>нет</p></svg><script>var a;</script></div><p>три<br>4<img alt='вид'><noscript>нет</noscript>"))
    assert page.lines == ["Раздва", "три", "4 вид"]  # a lone letter is no line
    assert page.scripts == ["var a;"] and "нет" not in page.words
    assert H.clean_lines("390 ₽\nв\nмес\n100\nМбит/с\n500\n600\n₽/мес\nя\n7") == ["390 ₽ мес", "100 Мбит/с", "500 ₽/мес", "600 ₽/мес", "7"]
    assert H.repaired("Ð´Ð¾Ð¼") == "дом" and H.repaired("дом Â") == "дом Â" and H.repaired("Ñ дом") == "Ñ дом"


def test_embedded_data_becomes_items(spark):
    tariffs = {"z": {"price": 500, "name": 'a "b"', "di_options": {"300_1": 100, "bad": 1}, "isOwnHouse": "true", "di_speedOwnHouse": 50}, "a": {"speed": 100, "isOwnHouse": False, "speedOwnHouse": 5}}
    inner = '5:["x",{"initialTariffs": ' + json.dumps(tariffs) + ', "more": 1}]'
    page = f"<script>self.__next_f.push([0])</script><script>self.__next_f.push([1,{json.dumps(inner[:20])}])</script><script>self.__next_f.push([1,{json.dumps(inner[20:])}])</script>"
    got, none, list_ = values(spark, [page, "nothing", page.replace(': {', ': [{')], S.embedded_items)
    assert [(x["tariff_id"], x["house_type"], x["speed_option"]) for x in json.loads(got)] == [("z", "flat", "300_1"), ("z", "house", "50"), ("a", "flat", "100")]
    assert json.loads(got)[0]["wifire_tariff"] == tariffs["z"] and none is None and list_ is None


def test_scripts_are_evidence():
    offer = {"@type": "Product", "name": "Домашний интернет 300", "offers": {"price": 550, "priceCurrency": "RUB"}, "text": "до 300 Мбит/с за 550 руб в месяц"}
    page = f'<script type="application/ld+json">{json.dumps(offer, ensure_ascii=False)}</script><script>var a = {{t: "тариф Старт", price: 400, скидка: 1}};</script><script>s={{speed: 100, price: 700}}</script><p>Пусто</p>'
    text = H.reduced(page)["text"]
    lines = text.split("[EMBEDDED DATA CANDIDATES]\n")[1].splitlines()
    assert lines[0] == ": @type=Product; name=Домашний интернет 300; text=до 300 Мбит/с за 550 руб в месяц"  # the best first
    assert "offers: price=550; priceCurrency=RUB" in lines and any("тариф Старт" in x for x in lines) and lines[-2:] == ["speed: 100", "price: 700"]
    long = H.script_evidence([json.dumps({"a": "тариф " * 900})], ["type=application/json"], 3600)
    assert [len(x) for x in long] == [1200]


def test_detail_page_and_compound_block():
    hero = ["Главная", "Домашний интернет", "Мегабыстрый Дома", "Для дома", "до 500 Мбит/с", "Роутер в аренду", "650 ₽/мес", "Подробные условия"]
    (block,) = H.detail_block(hero)
    assert block.splitlines()[0] == "Мегабыстрый Дома" and "650 ₽/мес" in block
    assert H.detail_block(["Мобильная связь", "Тариф Старт", "650 ₽/мес"]) == []
    two = "Домашний интернет\nТариф Старт\n100 Мбит/с\n400 ₽/мес\nПодробнее\nТариф Макс\n500 Мбит/с\n800 ₽/мес"
    assert [x.splitlines()[-1] for x in H.split_block(two)] == ["400 ₽/мес", "800 ₽/мес"] and H.split_block(two)[1].startswith("Тариф Макс")
    assert H.split_block("Тариф Старт\n100 Мбит/с\n400 ₽/мес") == ["Тариф Старт\n100 Мбит/с\n400 ₽/мес"]
    page = "".join(f"<p>{x}</p>" for x in hero)
    assert "detail" in {c["tier"] for c in H.candidates_of(page)}


def test_changes(spark):
    old, new = (spark.createDataFrame(r, "id int, price int") for r in ([(1, 500), (2, 1), (4, 9)], [(1, 450), (3, 1), (4, 9)]))
    got = {r.id: (r.type, r.before, r.after) for r in compare.changes(old, new, "id", ["price"]).collect()}
    assert got == {1: ("changed", {"price": "500"}, {"price": "450"}), 2: ("removed", {"price": "1"}, None), 3: ("added", None, {"price": "1"})}


def test_samples_take_turns(spark):
    d = spark.createDataFrame([(i, "a" if i < 8 else "b") for i in range(12)], "i int, g string")
    got = sampling.stratified(d, "g", "i", 2, 1, 1).orderBy("place").collect()
    assert [(r.i, r.split) for r in got] == [(0, "train"), (8, "train"), (1, "holdout"), (9, "smoke")]


def test_lists_at_any_depth(spark):
    from millrace.functions import tree as J

    rows = ['{"data":{"result":{"items":{"list":[{"a":1}]}}}}', '{"list":[],"items":[{"a":2}]}', '{"data":{"list":[]},"result":[{"z":3},3]}', "7", None, "[]", "bad"]
    v = A.parse(F.col("p"))
    got = spark.createDataFrame([(r,) for r in rows], "p string").select(F.transform(A.items(v), lambda x: F.to_json(x)).alias("i"), J.numbers_under(v, ["a", "z"]).alias("n")).collect()
    # A list ends its object's turn, even an empty one.
    assert [r.i for r in got] == [['{"a":1}'], [], ['{"z":3}'], [], [], [], []]
    assert [r.n for r in got[:3]] == [[1.0], [2.0], [3.0]]
    deep = '{"data":' * 33 + "{}" + "}" * 33
    with pytest.raises(Exception, match="deeper"):
        spark.createDataFrame([(deep,)], "p string").select(A.items(v)).collect()


def test_audit_of_odd_tables(spark):
    from millrace.operators import audit

    records = spark.createDataFrame([("a", "json", '[{"name":"x","price":5}]'), ("b", "json", "bad"), ("c", "html", "")], "source_record_id string, payload_type string, payload string")
    none = spark.createDataFrame([], f"source_record_id string, at long, facts {A.FACT_DDL}, raw variant")
    # Flat items without offers are another check's matter; nothing is there to compare.
    assert audit.faults(records, none).collect() == []
    one = spark.createDataFrame([("a", '{"name":"x","price":5}'), ("b", '{"name":"x"}')], "source_record_id string, j string")
    nothing = {"price": F.lit(5.0), "name": F.lit(" X")}
    names = [f.split(":")[0] for f in ("name", "variant_id", "price")]
    facts = F.from_json(F.to_json(F.struct(*[nothing.get(n, F.lit(None).cast("string")).alias(n) for n in names])), A.FACT_DDL)
    got = audit.item_faults(records, one.select("source_record_id", F.lit(0).cast("long").alias("at"), facts.alias("facts"), F.parse_json("j").alias("raw"))).collect()
    assert [(r.source_record_id, r.error) for r in got] == [("b", "raw_offer is no item of the response")]


def test_items_are_read_once(spark):
    from millrace.functions import tree as J
    from millrace.operators import audit

    rows = [("a", '[{"name":"x"},{"offer":{"b":2,"a":1}}]'), ("b", '{"items":[]}'), ("c", None), ("d", "{" + '"data":{' * 6 + '"list":[{"z":4}]' + "}" * 7)]
    d = spark.createDataFrame(rows, "source_record_id string, payload string").withColumn("payload_type", F.lit("json"))
    found = audit.item_sources(S.spread(d))
    assert sorted((r.source_record_id, r.expected, r.native) for r in found.collect()) == [("a", True, False), ("a", True, False), ("d", True, False)]
    assert [r[0] for r in d.orderBy("source_record_id").select(J.numbers_under(A.parse("payload"), ["b", "z"])).collect()] == [[2.0], [], [], [4.0]]
    # No filter computes the items again, before the rows are dealt to all cores.
    for needed in (found, found.where("native"), found.where("expected")):
        assert needed._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_lines_are_cut_once_for_prices(spark):
    d = spark.createDataFrame([("Тариф\n1 500\n900 ₽ в месяц\nмес",), ("500\n695\xa0645 руб/мес\n840",), ("Тариф\n100 Мбит/с\n1 500",), ("мес\n700",), (None,)], "x string")
    x = F.col("x")
    got = d.select(T.monthly_prices(x).alias("m"), T.standalone_old_price(T.lines(x), F.lit(645.0)).alias("a"), T.standalone_old_price(T.lines(x), F.lit(900.0)).alias("b"))
    assert [tuple(r) for r in got.collect()] == [([900.0], None, 1500.0), ([645.0], 840.0, None), ([], None, None), ([], None, None), (None, None, None)]
    # The pattern of line ends stands where a text is cut: not in what is done with each of its lines.
    cuts = lambda c: d.select(c)._jdf.queryExecution().analyzed().toString().count(r"\r\n|\n|\r")
    assert cuts(T.monthly_prices(x).alias("c")) == 1 and cuts(T.standalone_old_price(T.lines(x), F.lit(645.0)).alias("c")) == 2
