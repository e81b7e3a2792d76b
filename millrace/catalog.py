"""All registered queries of the engine with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import api as A
from millrace.functions import html as H
from millrace.functions import text as T
from millrace.functions import tree as J
from millrace.operators import audit, compare, evaluate, offers, quality, sampling, sequence, validate
from millrace.plans import normalize
from millrace.sources import snapshots

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _dealt(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table for costly work on each row."""
    return snapshots.spread(_t(spark, d, name))


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved page for each part: a tariff card with a name, a speed and a monthly price."""
    p = _dealt(spark, sf_dir, "part")
    price = F.floor("p_retailprice").cast("bigint").cast("string")
    page = F.concat(
        F.lit("<html><body><div><h2>Тариф Дома "), F.col("p_partkey").cast("string"), F.lit("</h2><p>"), (F.col("p_size") * 10).cast("string"), F.lit(" Мбит/с</p><p>"), price, F.lit(" руб./мес.</p></div></body></html>"),
    )
    return p.select(F.col("p_partkey").alias("source_record_id"), page.alias("payload"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tariff cards rendered from ``part``, read back as offers."""
    found = offers.html_offers(part_pages(spark, sf_dir))
    f = F.col("facts")
    return found.select(F.col("source_record_id").alias("p_partkey"), f["name"].alias("name"), f["internet_speed_mbps"].cast("bigint").alias("speed"), f["price"].cast("bigint").alias("price"), f["price_period"].alias("price_period"))


query("offer_roundtrip", "select p_partkey, 'Тариф Дома ' || p_partkey as name, cast(p_size * 10 as bigint) as speed, cast(floor(p_retailprice) as bigint) as price, 'месяц' as price_period from part")(flagship)


@query(
    "offer_old_price_roundtrip",
    "select p_partkey, cast(floor(p_retailprice) as bigint) as price, cast(floor(p_retailprice) as bigint) + 100 + p_size as price_old, round(100.0 * (100 + p_size) / (floor(p_retailprice) + 100 + p_size), 1) as discount from part",
)
def offer_old_price(spark, d):
    price = F.floor("p_retailprice").cast("bigint")
    block = F.concat_ws("\n", F.lit("Тариф Дома"), F.lit("100 Мбит/с"), (price + 100 + F.col("p_size")).cast("string"), F.concat(price.cast("string"), F.lit(" ₽ в месяц")), F.lit("Скидка новым абонентам"))
    p = _dealt(spark, d, "part").select("p_partkey", block.alias("block"))
    p = p.withColumn("price", F.get(T.monthly_prices(F.col("block")), F.lit(0)))
    p = p.withColumn("price_old", T.standalone_old_price(T.lines(F.col("block")), F.col("price")))
    return p.select("p_partkey", F.col("price").cast("bigint").alias("price"), F.col("price_old").cast("bigint").alias("price_old"), T.discount_value(F.col("price_old"), F.col("price")).alias("discount"))


@query(
    "offer_services_canonical",
    """select p_partkey, case p_size % 5 when 0 then 'internet,tv' when 1 then 'mobile,phone' when 2 then 'cinema' when 3 then 'gaming,other' else 'tv,internet' end as services from part""",
)
def offer_services(spark, d):
    words = [["Домашний интернет", "ТВ", "интернет"], ["Мобильная связь", "Звонки"], ["Онлайн-кинотеатр", " CINEMA "], ["Игровые опции", "Подписка", ""], ["телевидение", "Internet"]]
    lists = F.lit(words)
    return _t(spark, d, "part").select("p_partkey", F.array_join(T.services(F.get(lists, (F.col("p_size") % 5).cast("int"))), ",").alias("services"))


@query(
    "api_slider_explode",
    """select p_partkey, cast(o.id as varchar) as variant_id, cast(floor(p_retailprice) as bigint) + o.id as price, cast(p_size * o.id as bigint) as speed
       from part cross join (values (7), (8), (9)) o(id)""",
)
def api_slider(spark, d):
    option = lambda i: F.struct(F.lit(i).alias("id"), F.struct((F.floor("p_retailprice") + i).alias("value")).alias("totalPrice"), F.struct((F.col("p_size") * i).alias("numValue")).alias("internetSpeed"))
    item = F.struct(F.col("p_name").alias("titleForCard"), F.struct(F.lit(1).alias("value")).alias("totalPrice"), F.array().cast("array<string>").alias("productFeatureGroups"), F.array(*map(option, (7, 8, 9))).alias("internetOptions"))
    rows = _dealt(spark, d, "part").select("p_partkey", F.explode(A.variants(F.parse_json(F.to_json(item)))).alias("v"))
    f = rows.select("p_partkey", A.slider_facts(F.col("v.item"), F.col("v.option")).alias("f"))
    return f.select("p_partkey", "f.variant_id", F.col("f.price").cast("bigint").alias("price"), F.col("f.internet_speed_mbps").cast("bigint").alias("speed"))


@query(
    "api_catalog_items",
    """select o_orderkey, o_orderpriority as name, cast(floor(o_totalprice) as bigint) as price, 'мес' as price_period, 'internet' as services from orders""",
)
def api_catalog(spark, d):
    tariff = F.struct(
        F.col("o_orderpriority").alias("tariffName"), F.lit("x").alias("tariffType"), F.struct(F.floor("o_totalprice").alias("fee"), F.lit(0).alias("oldFee"), F.lit("₽/мес").alias("feeUnit")).alias("price"),
        F.array(F.struct(F.lit("speed").alias("name"), F.lit("300").alias("value"))).alias("parameters"),
    )
    body = F.struct(F.array(F.struct(F.lit("catalog").alias("alias"), F.struct(F.create_map(F.lit("g"), F.array(tariff)).alias("tariffs")).alias("data"))).alias("blocks"))
    rows = _dealt(spark, d, "orders").select("o_orderkey", F.explode(A.items(F.parse_json(F.to_json(body)))).alias("i"))
    f = rows.select("o_orderkey", A.parameter_facts(F.col("i")).alias("f"))
    return f.select("o_orderkey", "f.name", F.col("f.price").cast("bigint").alias("price"), "f.price_period", F.array_join("f.services", ",").alias("services"))


@query(
    "embedded_price_algebra",
    """with t as (select l_orderkey, l_linenumber, floor(l_extendedprice) as base, floor(l_quantity) as extra, cast(floor(l_tax * 100) as integer) as inc, floor(l_discount * 100) as pct, l_linenumber % 3 as k from lineitem)
       select l_orderkey, l_linenumber, cast(case k when 0 then base when 1 then base + inc + extra else ceil(base + inc + extra - floor((base + inc + extra) * pct / 100 + 0.5)) end as bigint) as price, cast(base + inc as bigint) as price_old from t""",
)
def embedded_price(spark, d):
    yes = F.lit(True)
    row = _t(spark, d, "lineitem").withColumn("k", F.col("l_linenumber") % 3)
    scope = F.when(F.col("k") == 0, "dominet").when(F.col("k") == 1, "").otherwise("city")
    price, old = A.embedded_price(F.floor("l_extendedprice").cast("double"), F.floor("l_quantity").cast("double"), F.floor(F.col("l_tax") * 100).cast("double"), F.floor(F.col("l_discount") * 100).cast("double"), yes, ~yes, yes, scope, F.lit(0.0))
    return row.select("l_orderkey", "l_linenumber", price.cast("bigint").alias("price"), old.cast("bigint").alias("price_old"))


@query(
    "page_title_shape",
    r"""select page_id, substr(lower(trim(regexp_replace(regexp_replace(regexp_extract(html, '<title[^>]*>([\s\S]*?)</title', 1), '\s+', ' ', 'g'), '[0-9]+', '#', 'g'))), 1, 120) as title_shape,
        cast(len(regexp_extract_all(html, '<h[1-3][^>]*>([\s\S]*?)</h[1-3]>')) as integer) as n_headings from pages""",
)
def page_title_shape(spark, d):
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title", 1)
    return _t(spark, d, "pages").select("page_id", T.shape(title).alias("title_shape"), F.size(F.regexp_extract_all("html", F.lit(r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>"), F.lit(0))).alias("n_headings"))


@query(
    "page_path_normalized",
    r"""with p as (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) as host, lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) as path from pages),
        q as (select page_id, host, regexp_replace(regexp_replace(regexp_replace(path, '/[0-9a-f-]{8,}', '/:id', 'g'), '/[0-9]+', '/:n', 'g'), '/+$', '') as path from p)
        select page_id, case when path = '' then '/' else path end as path, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain from q""",
)
def page_path(spark, d):
    return _t(spark, d, "pages").select("page_id", T.normalized_path(F.col("url")).alias("path"), T.domain(F.col("url")).alias("domain"))


@query(
    "record_ids",
    """select page_id, substr(sha256('p' || chr(0) || '' || chr(0) || '' || chr(0) || url || chr(0) || '2024'), 1, 24) as record_id, cast(('0x' || substr(sha1(url), 1, 14)) as bigint) as card_id from pages""",
)
def record_ids(spark, d):
    e = F.lit("")
    return _t(spark, d, "pages").select("page_id", T.record_id(F.lit("p"), e, e, F.col("url"), F.lit("2024")).alias("record_id"), T.offer_number(F.col("url")).alias("card_id"))


@query(
    "dedupe_keep_first",
    "select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) n from events) where n = 1",
)
def dedupe_keep_first(spark, d):
    return compare.first_by(_t(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query(
    "snapshot_diff",
    """with a as (select o_orderkey as k, o_orderstatus as s, o_orderpriority as p from orders where o_orderpriority <> '1-URGENT'),
       b as (select o_orderkey as k, case when o_totalprice > 200000 then 'X' else o_orderstatus end as s, o_orderpriority as p from orders where o_orderpriority <> '5-LOW')
       select coalesce(a.k, b.k) as o_orderkey, case when a.k is null then 'added' when b.k is null then 'removed' else 'changed' end as type,
         case when a.k is null then null when b.k is null then 's=' || a.s || ';p=' || a.p else 's=' || a.s end as before,
         case when b.k is null then null when a.k is null then 's=' || b.s || ';p=' || b.p else 's=' || b.s end as after
       from a full outer join b on a.k = b.k where a.k is null or b.k is null or a.s is distinct from b.s or a.p is distinct from b.p""",
)
def snapshot_diff(spark, d):
    o = _t(spark, d, "orders")
    # Two snapshots: urgent orders come, low ones go, costly ones change.
    old = o.where("o_orderpriority <> '1-URGENT'").select("o_orderkey", F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    new = o.where("o_orderpriority <> '5-LOW'").select("o_orderkey", F.when(F.col("o_totalprice") > 200000, "X").otherwise(F.col("o_orderstatus")).alias("s"), F.col("o_orderpriority").alias("p"))
    shown = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return compare.changes(old, new, "o_orderkey", ["s", "p"]).select("o_orderkey", "type", shown("before").alias("before"), shown("after").alias("after"))


@query("resume_antijoin", "select o_orderkey, o_custkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'R')")
def resume_antijoin(spark, d):
    done = _t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return compare.resume(_t(spark, d, "orders"), done, "o_orderkey").select("o_orderkey", "o_custkey")


@query("locality_join", "select c_custkey, n_name as city, cast(n_nationkey as bigint) as locality_id from customer left join nation on c_nationkey = n_nationkey")
def locality_join(spark, d):
    n = _t(spark, d, "nation")
    city = _t(spark, d, "customer").join(F.broadcast(n.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.col("n_name").alias("city"))
    return compare.with_locality(city, n.select(F.lower("n_name").alias("city_key"), F.col("n_nationkey").cast("long").alias("locality_id")))


@query("props_json_number", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, cast(json_extract_string(props, '$.k') as bigint) * 2 as doubled from events")
def props_json_number(spark, d):
    v = A.parse(F.col("props"))
    return _t(spark, d, "events").select("event_id", A.number_of(v, "$.k").cast("bigint").alias("k"), (A.number_of(v, "$.k") * 2).cast("bigint").alias("doubled"))


@query(
    "context_window_lines",
    """select conv_id, turn, coalesce(last_value(case when length(text) > 200 then turn end ignore nulls) over (partition by conv_id order by turn rows between 3 preceding and 1 preceding), -1) as previous,
       coalesce(first_value(case when length(text) > 200 then turn end ignore nulls) over (partition by conv_id order by turn rows between 1 following and 3 following), -1) as following from conversations""",
)
def context_window(spark, d):
    c = _t(spark, d, "conversations")
    return sequence.neighbours(c, ["conv_id"], "turn", F.when(F.length("text") > 200, F.col("turn")), 3, 3).select(
        "conv_id", "turn", F.coalesce("previous", F.lit(-1)).alias("previous"), F.coalesce("following", F.lit(-1)).alias("following")
    )


@query("block_sessionize", "select conv_id, turn, cast(sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn rows unbounded preceding) as bigint) as session from conversations")
def block_sessionize(spark, d):
    return sequence.sessions(_t(spark, d, "conversations"), ["conv_id"], "turn", F.col("role") == "user").select("conv_id", "turn", "session")


@query("line_gaps", "select l_orderkey, l_linenumber, coalesce(l_linenumber - lag(l_linenumber) over (partition by l_orderkey order by l_linenumber) > 1, true) as gap from (select distinct l_orderkey, l_linenumber from lineitem where l_quantity > 10)")
def line_gaps(spark, d):
    rows = _t(spark, d, "lineitem").where("l_quantity > 10").select("l_orderkey", "l_linenumber").distinct()
    return sequence.gaps(rows, ["l_orderkey"], "l_linenumber")


@query(
    "line_budget_prefix",
    """with l as (select doc_id, unnest(string_split(text, chr(10))) as x, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
       c as (select doc_id, length(x) + 1 as n, sum(length(x) + 1) over (partition by doc_id order by i) as used from l)
       select d.doc_id, cast(count(c.n) as integer) as kept, cast(coalesce(sum(c.n), 0) as integer) as kept_chars from documents d left join c on c.doc_id = d.doc_id and c.used <= 500 group by d.doc_id""",
)
def line_budget(spark, d):
    return sequence.lines_within(_t(spark, d, "documents").select("doc_id", "text"), "text", 500).select("doc_id", "kept", "kept_chars")


@query(
    "stratified_sample",
    """with g as (select page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as h from pages),
       r as (select *, row_number() over (partition by h order by page_id) as k, min(page_id) over (partition by h) as f from g),
       s as (select * from r where k <= 9 and f in (select distinct f from r order by f limit 24)),
       p as (select page_id, cast(row_number() over (order by k, f) as integer) as place from s)
       select page_id, place, case when place <= 4 then 'train' when place <= 7 then 'holdout' else 'smoke' end as split from p where place <= 9""",
)
def stratified_sample(spark, d):
    rows = _t(spark, d, "pages").select("page_id", T.host(F.col("url")).alias("h"))
    return sampling.stratified(rows, "h", "page_id").select("page_id", "place", "split")


@query("page_fingerprint_groups")
def page_fingerprint_groups(spark, d):
    r = _dealt(spark, d, "pages").select(F.lit("html").alias("payload_type"), "url", F.lit("").alias("city"), F.col("html").alias("payload"))
    return sampling.fingerprint(r).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("records"))


@query("html_reduced")
def html_reduced(spark, d):
    r = H.with_reduced(_dealt(spark, d, "pages").select("page_id", F.col("html").alias("payload"), F.lit("").alias("city")))
    return r.select("page_id", "reduced.text", "reduced.original_chars", "reduced.reduced_chars", "reduced.candidate_blocks")


# -- outcomes, gold cases, the gate ------------------------------------------------


def _outcomes(spark, d):
    """An outcome for each event: small values are skipped ones, large ones succeed."""
    ok = (F.col("value") > 10) & (F.col("value") > 2)
    return _t(spark, d, "events").select(F.col("event_type").alias("provider"), (F.col("value") <= 2).alias("skipped"), ok.alias("ok"), F.when(ok, F.floor("value") % 3).otherwise(0).alias("n_offers"))


@query(
    "provider_rollup",
    """select event_type as provider, count(*) as records, count(*) filter (value <= 2) as skipped, count(*) filter (value > 10) as succeeded, count(*) filter (value > 2 and value <= 10) as failed,
         count(*) filter (value > 10 and cast(floor(value) as bigint) % 3 = 0) as empty, cast(sum(case when value > 10 then cast(floor(value) as bigint) % 3 else 0 end) as bigint) as offers,
         count(*) filter (value > 10) / greatest(1.0, count(*) - count(*) filter (value <= 2)) as success_rate
       from events group by rollup (event_type)""",
)
def provider_rollup(spark, d):
    return normalize.statistics(_outcomes(spark, d))


def _groups(spark, d):
    rows = _outcomes(spark, d).where("not skipped").select(F.col("provider").alias("fingerprint"), "ok", "n_offers", (F.col("provider") == "error").alias("signal"))
    return quality.group_counters(rows)


_GROUPS = """with o as (select event_type as fingerprint, value > 10 as ok, case when value > 10 then cast(floor(value) as bigint) % 3 else 0 end as n, event_type = 'error' as signal from events where value > 2)"""


@query(
    "gate_groups",
    _GROUPS
    + """ select fingerprint, count(*) as records, count(*) filter (ok) as passed, count(*) filter (not ok) as failed, cast(sum(case when ok then n else 0 end) as bigint) as offers, count(*) filter (ok and n > 0) as positive_records,
         count(*) filter (ok and n = 0) as empty_records, count(*) filter (ok and signal) as independent_signal_records, count(*) filter (ok and signal and n = 0) as signal_without_output from o group by fingerprint""",
)
def gate_groups(spark, d):
    return _groups(spark, d)


@query(
    "gate_decision",
    _GROUPS
    + """ select 'failed' as status, count(*) filter (not ok) || ' records failed execution or validation; positive records ' || count(*) filter (ok and n > 0) || ' below required 1000000000; 2 approved gold cases differ' as hard,
         '3 gold template cases are pending manual approval' as soft from o""",
)
def gate_decision(spark, d):
    got = quality.decide(_groups(spark, d), approved=5, pending=3, failed=2, missing=0, min_positive=1_000_000_000)
    return got.select("status", F.array_join("hard_failures", "; ").alias("hard"), F.array_join("warnings", "; ").alias("soft"))


@query(
    "gold_compare",
    """select doc_id as case_id, case when doc_id % 4 = 0 then 'address' else 'id' end as way, exists (select 1 from documents d where d.doc_id = l.doc_id) as found from labels l where quality = 1""",
)
def gold_compare(spark, d):
    key = F.col("doc_id").cast("string")
    by_address = F.col("doc_id") % 4 == 0
    cases = _t(spark, d, "labels").select(
        F.col("doc_id").alias("case_id"), (F.col("quality") == 1).alias("approved"), F.when(~by_address, key).alias("source_record_id"), F.concat(F.lit("http://x/"), key).alias("source_url"), F.lit("ГОРОД").alias("city"), F.lit(1).alias("expected_offer_count"), F.lit("").alias("offers")
    )
    records = _t(spark, d, "documents").select(F.col("doc_id").alias("seq"), key.alias("source_record_id"), F.concat(F.lit("http://x/"), key).alias("url"), F.lit("Город").alias("city"))
    got = quality.matched_cases(cases, records).where(F.col("source_record_id") == F.col("case_id").cast("string")).select("case_id", F.lit(True).alias("found"))
    lost = quality.missing_cases(cases, got).select("case_id", F.lit(False).alias("found"))
    return got.union(lost).select("case_id", F.when(F.col("case_id") % 4 == 0, "address").otherwise("id").alias("way"), "found")


@query(
    "gold_differences",
    """select cast(p_partkey as integer) as case_id, case p_size % 4 when 0 then '' when 1 then 'offer 0 not found' when 2 then 'expected 3 offers, got 2; offer 2 not found' else 'offer 1 not found' end as differences from part""",
)
def gold_differences(spark, d):
    p = _t(spark, d, "part").withColumn("k", F.col("p_size") % 4)
    fields = ["name string", "price double", "price_old double", "internet_speed_mbps double", "tv_channels int", "mobile_minutes int", "mobile_data_gb double"]

    def offer(name, price, at=None):
        own = {"name": name, "price": price, "services": F.array(F.lit("internet"))}
        cols = [own.get(f.split()[0], F.lit(None)).cast(f.split()[1]).alias(f.split()[0]) for f in fields if f.split()[0] in quality.GOLD_FIELDS]
        return F.struct(*([F.lit(at).cast("long").alias("at")] if at is not None else []), *cols, own["services"].alias("services"))

    price = F.floor("p_retailprice").cast("double")
    wanted = [offer(F.lit(" тариф  А"), price + F.when(F.col("k") == 1, 1).otherwise(0)), offer(F.when(F.col("k") == 3, "иной").otherwise("Тариф А"), price)]
    third = F.when(F.col("k") == 2, F.array(offer(F.lit("Тариф В"), price))).otherwise(F.array().cast(f"array<struct<{','.join(f.replace(' ', ':') for f in fields if f.split()[0] in quality.GOLD_FIELDS)},services:array<string>>>"))
    key = F.col("p_partkey").cast("string").alias("source_record_id")
    cases = p.select(F.col("p_partkey").cast("int").alias("case_id"), key, F.when(F.col("k") == 2, 3).otherwise(2).alias("expected_offer_count"), F.concat(F.array(*wanted), third).alias("offers"))
    own = p.select(key, F.explode(F.array(offer(F.lit("Тариф А"), price, 0), offer(F.lit("ТАРИФ А"), price, 1))).alias("o")).select("source_record_id", "o.*")
    return quality.case_differences(cases, own).select("case_id", F.array_join("differences", "; ").alias("differences"))


@query(
    "record_refusals",
    """select event_id, case when event_id % 7 = 0 then 'source status: Error' when event_id % 7 = 1 then 'empty payload' when event_id % 7 = 2 then 'unsupported payload type' when event_id % 7 = 3 then 'invalid JSON' end as refusal,
         case when event_id % 7 = 2 then 'letai' when event_id % 7 = 4 then 'wifireru' else 'ones' end as adapter from events""",
)
def record_refusals(spark, d):
    k = F.col("event_id") % 7
    r = _t(spark, d, "events").select(
        "event_id", F.when(k == 2, "letai").when(k == 4, "wifire_ru").otherwise(F.concat(F.lit("../"), "event_type")).alias("provider"), F.when(k == 0, "Error").when(k == 5, "OK").when(k == 6, "200").alias("status"),
        F.when(k == 1, " ").when(k == 3, "{broken").when(k == 4, "<p>").otherwise(F.col("props")).alias("payload"), F.when(k == 4, "html").otherwise("json").alias("payload_type"),
    )
    r = r.withColumn("adapter", normalize.route(normalize.alias(F.col("provider"))))
    return r.select("event_id", normalize.refusal().alias("refusal"), "adapter")


@query("bounded_errors", "select event_type, array_to_string(list_slice(list_sort(list(event_id)), 1, 100), ',') as first_ids, count(*) as n from events group by event_type")
def bounded_errors(spark, d):
    return compare.first_values(_t(spark, d, "events"), "event_type", "event_id", 100).select("event_type", F.array_join("first", ",").alias("first_ids"), "n")


@query("best_attempt", "select l_suppkey, arg_max(l_partkey, (l_extendedprice, -l_partkey)) as best from lineitem group by l_suppkey")
def best_attempt(spark, d):
    return compare.best_by(_t(spark, d, "lineitem"), ["l_suppkey"], "l_partkey", [F.col("l_extendedprice"), -F.col("l_partkey")], "best")


# -- grounding ---------------------------------------------------------------------


@query(
    "evidence_grounding",
    """with w as (select doc_id, text, split_part(text, ' ', 2) as needle from documents)
       select doc_id, needle = '' or contains(lower(text), lower(needle)) as grounded, contains(lower(text), lower('@' || needle)) as marked, case when needle = '' then 0 else length(substr(text, strpos(text, needle), length(needle))) end as n from w where text is not null""",
)
def evidence_grounding(spark, d):
    needle = F.split_part("text", F.lit(" "), F.lit(2))
    rows = _t(spark, d, "documents").where("text is not null").select("doc_id", "text", needle.alias("needle"))
    upper = F.array(F.upper("needle"), F.lit(""))
    found = T.evidence_fragment(F.col("text"), F.col("needle"), 0)
    return rows.select("doc_id", validate.evidence_grounded(F.array(F.col("needle"), F.lit("")), F.col("text")).alias("grounded"), validate.evidence_grounded(F.array(F.concat(F.lit("@"), "needle")), F.col("text")).alias("marked"), F.least(F.length(found), F.length("needle")).alias("n"))


@query(
    "numbers_in_text",
    """select p_partkey, cast(case when p_size = floor(p_retailprice) then 2 else 3 end as integer) as n, cast(p_size as double) + case when p_size = floor(p_retailprice) then 0 else floor(p_retailprice) end + 1200.5 as total, true as stands, p_size < 10 and p_size * 10 + 7 = 17 as part from part""",
)
def numbers_in_text(spark, d):
    size, price = F.col("p_size").cast("string"), F.floor("p_retailprice").cast("string")
    text = F.concat(F.lit("от "), size, F.lit(" до "), price, F.lit("₽, 1 200,5 и "), size, F.lit(" штук"))
    p = _t(spark, d, "part").select("p_partkey", "p_size", T.numbers_in(text).alias("x"), T.number_in_text(F.floor("p_retailprice").cast("double"), text).alias("stands"), T.number_in_text(F.lit(17.0), F.concat(size, F.lit("7"))).alias("part"))
    return p.select("p_partkey", F.size("x").alias("n"), F.aggregate("x", F.lit(0.0), lambda a, b: a + b).alias("total"), "stands", "part")


@query(
    "offer_checks",
    """select p_partkey, array_to_string(list_filter([case when p_size % 3 = 0 then 'empty name' end, case when p_size % 5 = 0 then 'invalid price' end, case when p_size % 7 = 0 and p_size % 5 <> 0 then 'price_old is lower than price' end, case when p_size % 11 = 0 then 'internet_speed_mbps=77.0 is not grounded' end], lambda x: x is not null), '; ') as errors from part""",
)
def offer_checks(spark, d):
    p = _dealt(spark, d, "part")
    price = F.when(F.col("p_size") % 5 == 0, -F.lit(500.0)).otherwise(F.lit(500.0))
    own = {"name": F.when(F.col("p_size") % 3 == 0, " ").otherwise("Дом"), "price": price, "price_old": F.when(F.col("p_size") % 7 == 0, 400.0), "internet_speed_mbps": F.when(F.col("p_size") % 11 == 0, 77.0).otherwise(100.0)}
    kinds = {"name": "string", "variant_id": "string", "tv_channels": "int", "mobile_minutes": "int"}
    cols = ["name", "variant_id", *validate.NUMERIC]
    facts = F.struct(*[own.get(c, F.lit(None)).cast(kinds.get(c, "double")).alias(c) for c in cols])
    none = F.lit(None).cast("variant")
    found = p.select(F.col("p_partkey").alias("source_record_id"), F.lit(0).cast("long").alias("at"), F.lit("Дом\n100 Мбит/с\n500 руб./мес\nбыло 400\n-500").alias("block"), none.alias("item"), none.alias("option"), facts.alias("facts"))
    records = p.select(F.col("p_partkey").alias("source_record_id"), F.lit("html").alias("payload_type"), F.lit("").alias("payload"))
    got = validate.validate(records, found)
    # Whether a negative price stands in the text is not what this query asks.
    errors = F.filter("errors", lambda e: ~e.startswith("price=-"))
    return got.select(F.col("source_record_id").alias("p_partkey"), F.array_join(errors, "; ").alias("errors"))


# -- offers held against their sources ----------------------------------------------


def _told(faults: DataFrame) -> DataFrame:
    return faults.groupBy(F.col("source_record_id").alias("p_partkey")).agg(F.array_join(F.array_sort(F.collect_list("error")), "; ").alias("errors"))


@query(
    "audit_items",
    """with e as (select p_partkey, case when p_partkey % 2 = 0 and p_size % 11 = 0 then ['raw_offer is no item of the response']
         when p_partkey % 2 = 0 then [case when p_size % 7 = 0 then 'internet_speed_mbps stands under no matching key' end, case when p_size % 3 = 0 then 'name differs from the source' end, case when p_size % 5 = 0 then 'price differs from the source' end]
         else [case when p_size % 2 = 0 then 'cards or variants are missing, repeated or unexpected' end, case when p_size % 5 = 0 then 'price differs from the source' end] end as e from part)
       select p_partkey, array_to_string(list_filter(e, lambda x: x is not null), '; ') as errors from e where len(list_filter(e, lambda x: x is not null)) > 0""",
)
def audit_items(spark, d):
    """Flat items and slider cards of ``part``, read, then falsified, then audited."""
    p = _dealt(spark, d, "part")
    c, name, speed = F.floor("p_retailprice"), F.concat(F.lit("T"), F.col("p_partkey").cast("string")), F.col("p_size") * 10
    flat = F.to_json(F.struct(F.struct(F.array(F.struct(name.alias("name"), c.alias("price"), speed.alias("speedVal"))).alias("items")).alias("data")))
    option = lambda i: F.struct(F.lit(i).alias("id"), F.struct((c + i).alias("value")).alias("totalPrice"), F.struct(speed.alias("numValue")).alias("internetSpeed"))
    card = F.struct(name.alias("titleForCard"), F.struct(F.lit(1).alias("value")).alias("totalPrice"), F.array().cast("array<string>").alias("productFeatureGroups"), F.array(option(7), option(8)).alias("internetOptions"))
    payload = F.when(F.col("p_partkey") % 2 == 0, flat).otherwise(F.to_json(F.array(card)))
    records = p.select(F.col("p_partkey").alias("source_record_id"), F.lit("json").alias("payload_type"), payload.alias("payload"), "p_size")
    made = offers.json_offers(records).join(records.select("source_record_id", "p_size"), "source_record_id")
    raw = F.when(F.col("option").isNull(), F.col("item")).otherwise(F.parse_json(F.concat(F.lit('{"offer":'), F.to_json("item"), F.lit(',"internet_option":'), F.to_json("option"), F.lit("}"))))
    n, f = F.col("p_size"), F.col("facts")
    even = F.col("source_record_id") % 2 == 0
    made = made.withColumn("raw", F.when(even & (n % 11 == 0), F.parse_json(F.lit('{"name":"no"}'))).otherwise(raw))
    # By the option, so that facts are computed only where they are compared.
    seventh = A.text_of(F.col("option"), "$.id") == "7"
    made = made.where(even | seventh | (n % 2 == 1))
    false = f.withField("price", f["price"] + F.when((n % 5 == 0) & (even | seventh), 1).otherwise(0)).withField("name", F.when(even & (n % 3 == 0), "X").otherwise(f["name"]))
    false = false.withField("internet_speed_mbps", f["internet_speed_mbps"] + F.when(even & (n % 7 == 0), 0.5).otherwise(0))
    return _told(audit.item_faults(records, made.select("source_record_id", "at", false.alias("facts"), "raw")))


@query(
    "audit_pages",
    """select p_partkey, case p_size % 6 when 1 then 'name differs from its block' when 2 then 'price differs from its block; price is not a recurring monthly price'
         when 3 then 'raw_offer is no block of the page' when 4 then 'expected 1 offers, got 0' else 'block used again; expected 1 offers, got 2' end as errors from part where p_size % 6 > 0""",
)
def audit_pages(spark, d):
    """Offers of the cards of ``part``, falsified, then audited."""
    records = part_pages(spark, d).withColumn("payload_type", F.lit("html"))
    sizes = _t(spark, d, "part").select(F.col("p_partkey").alias("source_record_id"), (F.col("p_size") % 6).alias("k"))
    made = offers.html_offers(records).join(sizes, "source_record_id").where("k <> 4")
    k, f = F.col("k"), F.col("facts")
    false = f.withField("name", F.when(k == 1, "X").otherwise(f["name"])).withField("price", f["price"] + F.when(k == 2, 1).otherwise(0))
    block = F.when(k == 3, "other").otherwise(F.col("block"))
    made = made.select("source_record_id", F.explode(F.when(k == 5, F.expr("array(0L, 1L)")).otherwise(F.expr("array(0L)"))).alias("at"), false.alias("facts"), F.to_json(F.struct(block.alias("block"))).alias("j"))
    return _told(audit.page_faults(records, made.select("source_record_id", "at", "facts", F.parse_json("j").alias("raw"))))


@query(
    "price_kinds",
    """select p_partkey, ['monthly', 'monthly', 'monthly', 'yearly', 'unspecified', null, 'monthly', null][p_partkey % 8 + 1] as kind from part""",
)
def price_kinds(spark, d):
    texts = [
        "Дом\n@c руб./мес", "Дом\nмесяц всего @c ₽", "Дом 100 Мбит/с\n@c\nмес", "Дом\n@c руб/год", "[UNSPECIFIED BILLING]\n[SOURCE PRICE] <span data-cost=\"@c\">x</span>", "Дом @c", '{speed: 100, price: "@c"}',
        "Аренда @c ₽",
    ]
    c = F.floor("p_retailprice").cast("bigint").cast("string")
    p = _dealt(spark, d, "part").select("p_partkey", F.floor("p_retailprice").cast("double").alias("price"), F.replace(F.get(F.lit(texts), (F.col("p_partkey") % 8).cast("int")), F.lit("@c"), c).alias("block"))
    period = F.when(F.col("p_partkey") % 8 == 3, "год").when(F.col("p_partkey") % 8 != 4, "мес")
    return p.select("p_partkey", audit.price_kind(F.col("price"), period, F.col("block")).alias("kind"))


@query(
    "json_omissions",
    """select p_partkey, array_to_string(list_filter([case when p_size % 2 = 0 then 'price left out' end, case when p_size % 3 = 0 then 'price_old left out' end, case when p_size % 5 = 0 then 'internet_speed_mbps left out' end, case when p_size % 7 = 0 then 'service tv left out' end], lambda x: x is not null), '; ') as missing from part""",
)
def json_omissions(spark, d):
    n, c = F.col("p_size"), F.floor("p_retailprice")
    product = lambda code, speed=None: F.struct(F.lit(code).alias("productCode"), F.lit(None if speed is None else 1).cast("int").alias("x"), (F.lit(None) if speed is None else speed).cast("string").alias("speedVal"))
    raw = F.struct(c.alias("price"), F.when(n % 3 == 0, c + 100).otherwise(c - 1).alias("price_old"), F.array(product("SHPD", F.concat(n.cast("string"), F.lit(" Мбит/с"))), product("IPTV"), product("NONE")).alias("products"))
    facts = F.struct(
        F.when(n % 2 == 1, c.cast("double")).alias("price"), F.lit(None).cast("double").alias("price_old"), F.when(n % 5 == 0, 0.0).otherwise(n.cast("double")).alias("internet_speed_mbps"),
        F.when(n % 7 == 0, F.array(F.lit("internet"))).otherwise(F.array(F.lit("internet"), F.lit("tv"))).alias("services"),
    )
    rows = _t(spark, d, "part").select("p_partkey", F.parse_json(F.to_json(raw)).alias("raw"), facts.alias("facts"))
    return rows.select("p_partkey", F.array_join(audit.omissions(F.col("facts"), F.col("raw")), "; ").alias("missing"))


@query(
    "json_walk",
    """select p_partkey, cast(4 + p_size % 3 as bigint) as n_dicts, cast(p_partkey + case when p_size = p_partkey then 0 else p_size end + 0.5 as double) as total, case when p_size % 2 = 0 then 'b' else 'c' end as first, cast(p_size % 3 as bigint) as n_items from part""",
)
def json_walk(spark, d):
    """All objects, numbers under a key, the first filled field, and a list five keys deep."""
    n = F.col("p_size")
    rows = F.transform(F.sequence(F.lit(0), n % 3), lambda i: F.struct(i.alias("i")))
    deep = F.struct(F.struct(F.slice(rows, F.lit(1), n % 3).alias("list")).alias("items"))
    flat = F.struct(F.col("p_partkey").alias("speed"), F.array(F.struct(n.alias("speed"), F.lit("7").alias("other"))).alias("z"), F.struct(F.lit(0.5).alias("speed"), F.lit("9").alias("t")).alias("w"))
    named = F.struct(F.lit("").alias("a"), F.when(n % 2 == 0, "b").otherwise("").alias("b"), F.lit("c").alias("c"))
    p = _dealt(spark, d, "part").select("p_partkey", *[F.parse_json(F.to_json(x)).alias(k) for k, x in (("flat", flat), ("named", named))], F.parse_json(F.to_json(F.struct(F.struct(deep.alias("result")).alias("data")))).alias("deep"))
    return p.select(
        "p_partkey", F.size(J.dicts(F.col("deep"))).cast("bigint").alias("n_dicts"), F.aggregate(J.numbers_under(F.col("flat"), ["speed"]), F.lit(0.0), lambda a, b: a + b).alias("total"),
        A.first_field(F.col("named"), ["a", "b", "c"], "string").alias("first"), F.size(A.items(F.col("deep"))).cast("bigint").alias("n_items"),
    )


@query(
    "bag_differences",
    """with a as (select l_partkey % 50 as k, count(*) as n from lineitem where l_returnflag = 'A' group by 1), b as (select l_partkey % 50 as k, count(*) as n from lineitem where l_returnflag = 'R' group by 1)
       select cast(coalesce(a.k, b.k) as bigint) as k, coalesce(a.n, 0) as in_a, coalesce(b.n, 0) as in_b from a full join b on a.k = b.k where coalesce(a.n, 0) <> coalesce(b.n, 0)""",
)
def bag_differences(spark, d):
    rows = _t(spark, d, "lineitem").select((F.col("l_partkey") % 50).alias("k"), "l_returnflag")
    return audit.bag_differences(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag = 'R'"), ["k"])


# -- attempts -----------------------------------------------------------------------


def _attempts(spark, d):
    n = F.col("o_orderkey")
    return _t(spark, d, "orders").select(
        F.col("o_orderkey").alias("source_record_id"), "o_orderstatus", (F.col("o_custkey") % 5).alias("attempt"), (F.col("o_orderpriority") != "1-URGENT").alias("ok"), (F.col("o_custkey") % 4).alias("n_offers"),
        F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (n % 3).cast("int")).alias("problems"),
    )


_EVALUATED = """select o_orderstatus, {keys} count(*) filter (o_orderpriority <> '1-URGENT') as passed, count(*) filter (o_orderpriority = '1-URGENT') as failed, cast(sum(o_custkey % 4) as bigint) as offers,
         cast(sum(case when o_orderpriority = '1-URGENT' then greatest(1, o_orderkey % 3) else 0 end) as bigint) as violations from orders group by all"""


@query("evaluation_score", f"select *, 1000 * passed + offers - 2000 * failed - 50 * violations as score from ({_EVALUATED.format(keys='')})")
def evaluation_score(spark, d):
    return evaluate.evaluation(_attempts(spark, d), "o_orderstatus")


@query("attempt_choice", f"select o_orderstatus, arg_max(attempt, (1000 * passed + offers - 2000 * failed - 50 * violations, -attempt)) as attempt from ({_EVALUATED.format(keys='o_custkey % 5 as attempt,')}) group by o_orderstatus")
def attempt_choice(spark, d):
    return evaluate.best_attempt(_attempts(spark, d), "o_orderstatus", "attempt")


@query("split_prints", "select event_type as split, array_to_string(list_sort(list(distinct cast(user_id % 7 as varchar))), ',') as fingerprints from events group by event_type")
def split_prints(spark, d):
    rows = _t(spark, d, "events").select(F.col("event_type").alias("split"), (F.col("user_id") % 7).cast("string").alias("fingerprint"))
    return evaluate.split_prints(rows).select("split", F.array_join("fingerprints", ",").alias("fingerprints"))


@query("repair_lookup", "select o_orderkey, o_totalprice from orders where o_orderkey = (select min(o_orderkey) from orders where o_orderpriority = '1-URGENT')")
def repair_lookup(spark, d):
    records = _t(spark, d, "orders").select(F.col("o_orderkey").alias("source_record_id"), "o_totalprice")
    return evaluate.to_repair(_attempts(spark, d), records, "source_record_id").select(F.col("source_record_id").alias("o_orderkey"), "o_totalprice")


@query(
    "run_counters",
    """select count(*) as rows, count(*) filter (o_orderkey % 5 > 0 and o_orderkey % 2 = 1) as llm_calls, count(*) filter (o_orderkey % 5 > 0 and o_orderkey % 2 = 0) as cache_hits,
         cast(sum(o_custkey % 4) filter (o_orderkey % 5 > 0) as bigint) as offers, count(*) filter (o_orderkey % 5 > 0 and o_orderstatus = 'F') as unavailable, count(*) filter (o_orderkey % 5 = 0) as errors from orders""",
)
def run_counters(spark, d):
    n = F.col("o_orderkey")
    rows = _t(spark, d, "orders").select((n % 2 == 0).alias("cached"), (F.col("o_custkey") % 4).alias("n_offers"), F.when(F.col("o_orderstatus") == "F", "unavailable").otherwise("available").alias("availability"), F.when(n % 5 == 0, "x").alias("error"))
    return evaluate.run_counters(rows)


@query("pending_rows", "select c_custkey, c_mktsegment as city from customer where contains(lower(c_mktsegment), 'auto') and c_custkey % 3 <> 0 order by c_custkey limit 10")
def pending_rows(spark, d):
    rows = _t(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("city"))
    return compare.pending(rows, rows.where("c_custkey % 3 = 0"), "c_custkey", "c_custkey", city="AUTO", limit=10)


@query("first_terms", "select p_partkey, list_filter(string_split(p_name, ' '), lambda x: contains(lower(x), 'e') or contains(lower(x), 'a'))[1] as word, nullif(list_filter(string_split(p_name, ' '), lambda x: x <> '')[1], '') as first from part")
def first_terms(spark, d):
    words = F.split("p_name", " ")
    return _t(spark, d, "part").select("p_partkey", T.first_with(words, "E", "a").alias("word"), T.first_with(words).alias("first"))


# -- pages -------------------------------------------------------------------------


@query(
    "html_visible_text",
    """select p_partkey, p_name || ' ' || p_type || ' ' || p_size || ' <b>' as visible from part""",
)
def html_visible_text(spark, d):
    page = F.concat(F.lit("<title>"), "p_name", F.lit("</title><style>p{}</style><p>"), "p_type", F.lit("</p><script>var a=1;</script><svg><text>no</text></svg><br><i>"), F.col("p_size").cast("string"), F.lit("</i>&nbsp;&lt;b&gt;<noscript>no</noscript>"))
    return H.with_visible_text(_dealt(spark, d, "part").select("p_partkey", page.alias("html"))).select("p_partkey", "visible")


@query(
    "card_families",
    """with p as (select p_partkey, 'T' || p_partkey as t, p_size * 10 || ' Мбит/с' as s, cast(floor(p_retailprice) as bigint) as c, p_partkey % 6 as k from part)
       select p_partkey, case k
         when 0 then '[DOM CARD TITLE]|' || t || '|' || c || ' ₽ / мес|' || t || '|' || s || '|' || c || ' ₽ / мес'
         when 1 then '[DOM CARD TITLE]|' || t || '|Акционный тариф|' || (c + 100) || '|' || c || ' ₽/мес|' || t || '|' || s || '|' || (c + 100) || '|' || c || ' ₽/мес'
         when 2 then t || '|Акционный тариф|' || (c + 100) || ' ₽|' || c || ' ₽|Можно добавить: Wink|' || t || '|' || s || '|' || c || ' ₽|' || (c + 100) || ' ₽'
         when 3 then t || '|' || t || '|' || s || '|' || c || ' руб./мес'
         when 4 then t || '|' || s || '|' || s || '|' || c || ' ₽/мес'
         else t || '|' || s || '|Описание|[UNSPECIFIED BILLING]|Цена тарифа: ' || c || ' ₽|[SOURCE PRICE] <b class="m-tariff__price-value" data-cost="' || c || '">x</b>' end as card from p""",
)
def card_families(spark, d):
    """A page of one of six kinds for each part, read back as its card."""
    c = F.floor("p_retailprice").cast("bigint")
    marks = {"@t": F.concat(F.lit("T"), F.col("p_partkey").cast("string")), "@s": (F.col("p_size") * 10).cast("string"), "@o": (c + 100).cast("string"), "@c": c.cast("string")}
    pages = [
        '<div class="rates-list-internet__item"><p class="rates-list-internet__item-title">@t</p><p>@s Мбит/с</p><p class="rates-list-internet__item-price">@c ₽ / мес</p></div>',
        '<div class="card__wrapper"><p class="card-title">@t</p><p>@s Мбит/с</p><p class="price-sale">@o</p><p class="price-main">@c ₽/мес</p><div class="m-tariff__options">Кино</div></div>',
        '<div class="catalog-service-card"><p class="catalog-service-card__name">@t</p><p>@s Мбит/с</p><p class="catalog-service-card__linked-products"><i class="catalog-service-card__linked-product">Wink</i></p><div class="catalog-service-card__footer"><p class="catalog-price__value">@c ₽</p><p class="catalog-price__original">@o ₽</p></div></div>',
        '<div class="general-cont" itemtype="http://schema.org/Offer"><p class="name-title">@t</p><p>@s Мбит/с</p><p>@c руб./мес</p></div>',
        '<div itemtype="http://schema.org/Product"><meta itemprop="name" content="@t"><meta itemprop="price" content="@c"><p itemprop="additionalProperty"><meta itemprop="name" content="internetSpeed"><meta itemprop="value" content="@s"></p><div class="rate-card_card"><p>@s Мбит/с</p><p>@c ₽/мес</p></div></div>',
        '<div class="m-tariff"><p class="m-tariff__name">@t</p><p class="m-tariff__speed">@s Мбит/с</p><b class="m-tariff__price-value" data-cost="@c">x</b><p class="m-tariff__description">Описание</p></div>',
    ]
    page = F.get(F.lit(pages), (F.col("p_partkey") % 6).cast("int"))
    for mark, value in marks.items():
        page = F.replace(page, F.lit(mark), value)
    got = H.with_candidates(_dealt(spark, d, "part").select("p_partkey", page.alias("payload")))
    return got.select("p_partkey", F.replace(F.array_join(F.transform("candidates", lambda x: x["block"]), "#"), F.lit("\n"), F.lit("|")).alias("card"))


@query(
    "embedded_items",
    """select p_partkey, 't' || p_partkey as tariff_id, h.house as house_type, case when h.house = 'house' then cast(p_size as varchar) else p_size || '_1' end as speed_option from part cross join (values ('flat'), ('house')) h(house) where h.house = 'flat' or p_size % 2 = 0""",
)
def embedded_items(spark, d):
    size = F.col("p_size").cast("string")
    own = F.struct(F.create_map(F.concat(size, F.lit("_1")), F.lit(100), F.lit("bad"), F.lit(1)).alias("di_options"), F.when(F.col("p_size") % 2 == 0, "true").otherwise("false").alias("isOwnHouse"), F.col("p_size").alias("di_speedOwnHouse"))
    whole = F.concat(F.lit('{"initialTariffs":'), F.to_json(F.create_map(F.concat(F.lit("t"), F.col("p_partkey").cast("string")), own)), F.lit(',"x":[1]}'))
    pushed = lambda x: F.concat(F.lit("<script>self.__next_f.push([1,"), F.expr("1") if x is None else F.substring(F.to_json(F.array(x)), 2, 1_000_000), F.lit(")</script>"))
    page = F.concat(pushed(F.substring(whole, 1, 20)), pushed(F.substring(whole, 21, 1_000_000)))
    rows = _t(spark, d, "part").select("p_partkey", snapshots.embedded_items(page).alias("j"))
    item = F.explode(F.from_json("j", "array<struct<tariff_id:string,house_type:string,speed_option:string>>")).alias("i")
    return rows.select("p_partkey", item).select("p_partkey", "i.tariff_id", "i.house_type", "i.speed_option")


# -- scalar functions: cases by key, expected values in the SQL ---------------------


def _cases(spark, d, values):
    return _t(spark, d, "part").select("p_partkey", F.get(F.lit(values), (F.col("p_partkey") % len(values)).cast("int")).alias("x"))


@query("scalar_numbers", "select p_partkey, [1200.5, 100200, null, 0.5, -3][p_partkey % 5 + 1] as number, [1200, 100200, null, 0, -3][p_partkey % 5 + 1] as whole from part")
def scalar_numbers(spark, d):
    rows = _cases(spark, d, ["от 1 200,50 ₽", "100 200", "нет", "0.5 Гб", "-3 градуса"])
    return rows.select("p_partkey", T.number(F.col("x")).alias("number"), T.integer(F.col("x")).alias("whole"))


@query(
    "scalar_texts",
    """select p_partkey, ['a b', null, 'Дом', '100 Мбит/с'][p_partkey % 4 + 1] as clean, ['a b', '', 'дом', '100 мбит/с'][p_partkey % 4 + 1] as folded, ['A', 'B', 'C', 'D'][p_partkey % 4 + 1] || '_' as safe,
         case p_partkey % 4 when 2 then 'Дом' when 3 then null when 0 then ' a  b ' else '' end as technology, case p_partkey % 4 when 0 then ' a  b ' when 1 then 'мес' when 2 then 'Дом' else '100 Мбит/с' end as period from part""",
)
def scalar_texts(spark, d):
    rows = _cases(spark, d, [" a  b ", "", "Дом", "100 Мбит/с"])
    name = F.concat(F.get(F.lit(["A", "B", "C", "D"]), (F.col("p_partkey") % 4).cast("int")), F.lit(':<>"/'))
    return rows.select("p_partkey", T.clean(F.col("x")).alias("clean"), T.folded(F.col("x")).alias("folded"), T.safe_name(name).alias("safe"), T.technology(F.col("x")).alias("technology"), T.period(F.col("x")).alias("period"))


@query("scalar_mojibake", "select p_partkey, 'дом ' || p_partkey as repaired, 'Ñ дом' as kept from part")
def scalar_mojibake(spark, d):
    text = F.decode(F.encode(F.concat(F.lit("дом "), F.col("p_partkey").cast("string")), "UTF-8"), "ISO-8859-1")
    return _t(spark, d, "part").select("p_partkey", T.repair_mojibake(text).alias("repaired"), T.repair_mojibake(F.lit("Ñ дом")).alias("kept"))


@query("scalar_prices", "select p_partkey, cast(floor(p_retailprice) as double) as monthly, cast(p_size * 1000 as double) as speed, cast(p_size * 100 as double) as second from part")
def scalar_prices(spark, d):
    c = F.floor("p_retailprice").cast("bigint").cast("string")
    block = F.concat(F.lit("Тариф\n"), F.col("p_size").cast("string"), F.lit(" Гбит/с\n"), c, F.lit(" ₽\nв месяц\nАренда роутера\n150 руб/мес"))
    pair = F.concat((F.col("p_size") * 200).cast("string"), F.lit("/"), (F.col("p_size") * 100).cast("string"), F.lit(" Мбит/с"))
    return _dealt(spark, d, "part").select("p_partkey", F.get(T.monthly_prices(block), F.lit(0)).alias("monthly"), F.get(T.speeds(block), F.lit(0)).alias("speed"), F.get(T.speeds(pair), F.lit(1)).alias("second"))
