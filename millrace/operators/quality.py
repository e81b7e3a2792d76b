"""The quality gate: counters by structural group, approved gold cases, and a decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GOLD_FIELDS = ["name", "price", "price_old", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb"]
GOLD_DDL = (
    "approved boolean, source_record_id string, source_url string, city string, expected_offer_count long, offers array<struct<name:string,price:double,price_old:double,"
    "internet_speed_mbps:double,tv_channels:int,mobile_minutes:int,mobile_data_gb:double,services:array<string>>>, review_note string"
)
# What independently of any adapter looks like an offer.
HOME = r"(?iuU)(?:домашн\w*\s+интернет|интернет\s+для\s+дома|тариф)"
RECURRING = r"(?iuU)(?:\d[\d  ]{0,8}\s*(?:₽|руб(?:\.|лей)?|р\.?)\s*(?:/|в\s+)?\s*(?:мес|месяц)|\d{2,8}\s*\n\s*(?:руб\.?|р\.?)?\s*/?\s*(?:мес|месяц))"
SPEED = r"(?iuU)\d+(?:[.,]\d+)?\s*(?:мбит|гбит|mbps|gbps)"


def independent_signal(visible):
    """Whether a monthly price stands within 800 characters of a speed and of home internet words."""
    near = F.regexp_extract_all(visible, F.lit(r"(?s).{0,800}" + RECURRING.replace("(?iuU)", "(?iuU:") + ").{0,800}"), F.lit(0))
    return F.exists(near, lambda x: x.rlike(SPEED) & x.rlike(HOME))


def load_gold(spark: SparkSession, path: str) -> DataFrame:
    """(case_id and the case's fields) of a gold file."""
    doc = spark.read.schema(f"version int, provider string, cases array<struct<{GOLD_DDL.replace(' boolean', ':boolean').replace(' string', ':string').replace(' long', ':long').replace(' array', ':array')}>>")
    cases = doc.option("multiLine", True).json(path)
    return cases.select(F.posexplode("cases").alias("case_id", "c")).select("case_id", "c.*")


def matched_cases(cases: DataFrame, records: DataFrame) -> DataFrame:
    """Approved cases with the record each is held against: by id (of equal ids the last case), else the first record of its address and city."""
    good = cases.where("approved")
    by_id = good.where("source_record_id is not null and source_record_id <> ''")
    last = Window.partitionBy("source_record_id").orderBy(F.desc("case_id"))
    by_id = by_id.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")
    first = Window.partitionBy("case_id").orderBy("seq")
    ids = by_id.join(records.select("seq", "source_record_id"), "source_record_id").withColumn("__n", F.row_number().over(first)).where("__n = 1")
    r = records.select("seq", F.col("source_record_id").alias("__id"), F.col("url").alias("__u"), F.lower("city").alias("__c"))
    at = good.where("(source_record_id is null or source_record_id = '') and source_url is not null")
    at = at.join(r, (F.col("source_url") == F.col("__u")) & (F.lower(F.coalesce("city", F.lit(""))) == F.col("__c")))
    at = at.withColumn("__n", F.row_number().over(first)).where("__n = 1").withColumn("source_record_id", F.col("__id"))
    cols = ["case_id", "source_record_id", "expected_offer_count", "offers"]
    return ids.select(*cols).union(at.select(*cols))


def missing_cases(cases: DataFrame, matched: DataFrame) -> DataFrame:
    return cases.where("approved").join(matched.select("case_id"), "case_id", "left_anti")


def case_differences(matched: DataFrame, offers: DataFrame) -> DataFrame:
    """(case_id, source_record_id, differences): expected offers taken in turn by the first free equal offer."""
    own = offers.groupBy("source_record_id").agg(F.sort_array(F.collect_list(F.struct("at", *GOLD_FIELDS, "services"))).alias("found"))
    rows = matched.join(own, "source_record_id", "left").select("case_id", "source_record_id", "expected_offer_count", F.col("offers").alias("wanted"), "found")

    def same(want, have) -> bool:
        for k in [*GOLD_FIELDS, "services"]:
            w, h = want[k], have[k]
            if isinstance(w, str) and isinstance(h, str):
                w, h = (" ".join(x.casefold().split()) for x in (w, h))
            if k == "services" and w is not None:
                w, h = list(w), list(h or [])
            if w != h:
                return False
        return True

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for r in b.to_pylist():
                wanted, free, diff = r["wanted"] or [], list(r["found"] or []), []
                if r["expected_offer_count"] is not None and r["expected_offer_count"] != len(free):
                    diff.append(f"expected {r['expected_offer_count']} offers, got {len(free)}")
                for i, w in enumerate(wanted):
                    hit = next((j for j, h in enumerate(free) if same(w, h)), None)
                    if hit is None:
                        diff.append(f"offer {i} not found")
                    else:
                        free.pop(hit)
                out.append(diff)
            yield pa.RecordBatch.from_arrays([b.column("case_id"), b.column("source_record_id"), pa.array(out, pa.list_(pa.string()))], names=["case_id", "source_record_id", "differences"])

    return rows.mapInArrow(run, "case_id int, source_record_id string, differences array<string>")


def group_counters(outcomes: DataFrame) -> DataFrame:
    """Counters by fingerprint of rows (fingerprint, ok, n_offers, signal)."""
    fine = F.col("ok")
    return outcomes.groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(fine).alias("passed"), F.count_if(~fine).alias("failed"), F.sum(F.when(fine, F.col("n_offers")).otherwise(0)).alias("offers"),
        F.count_if(fine & (F.col("n_offers") > 0)).alias("positive_records"), F.count_if(fine & (F.col("n_offers") == 0)).alias("empty_records"),
        F.count_if(fine & F.col("signal")).alias("independent_signal_records"), F.count_if(fine & F.col("signal") & (F.col("n_offers") == 0)).alias("signal_without_output"),
    )


def decide(groups: DataFrame, approved: int, pending: int, failed: int, missing: int, min_positive: int = 0, min_offers: int = 0, require_gold: bool = False) -> DataFrame:
    """One row: status (failed, passed with approved gold, else provisional), hard failures, warnings, totals."""
    names = ["records", "passed", "failed", "offers", "positive_records", "empty_records", "independent_signal_records", "signal_without_output"]
    silent = F.collect_list(F.when((F.col("independent_signal_records") > 0) & (F.col("positive_records") == 0), F.concat(F.lit("fingerprint "), F.col("fingerprint"), F.lit(": signals but no offers"))))
    t = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.slice(F.sort_array(silent), 1, 100).alias("silent"))
    n = lambda c: F.col(c).cast("string")
    hard = F.array_compact(
        F.array(
            F.when(F.col("failed") > 0, F.concat(n("failed"), F.lit(" records failed execution or validation"))),
            F.when(F.col("positive_records") < min_positive, F.concat(F.lit("positive records "), n("positive_records"), F.lit(f" below required {min_positive}"))),
            F.when(F.col("offers") < min_offers, F.concat(F.lit("offers "), n("offers"), F.lit(f" below required {min_offers}"))),
            F.when(F.lit(failed) > 0, f"{failed} approved gold cases differ"),
            F.when(F.lit(missing) > 0, f"{missing} approved gold cases were not found in the input"),
            F.when(F.lit(require_gold and not approved), "no approved gold cases; strict certification is impossible"),
            F.when((F.col("independent_signal_records") > 0) & (F.col("positive_records") == 0), "all records with independent offer signals produced zero offers"),
        )
    )
    t = t.withColumn("hard_failures", hard).withColumn("warnings", F.concat("silent", F.array_compact(F.array(F.when(F.lit(pending) > 0, f"{pending} gold template cases are pending manual approval")))))
    return t.withColumn("status", F.when(F.size("hard_failures") > 0, "failed").when(F.lit(approved) > 0, "passed").otherwise("provisional")).drop("silent")


def gold_template(sample: DataFrame, offers: DataFrame, cases: int = 20) -> DataFrame:
    """Unapproved cases for a reviewer, from the first rows of a stratified sample (source_record_id, url, city, place)."""
    own = offers.groupBy("source_record_id").agg(F.sort_array(F.collect_list(F.struct("at", *GOLD_FIELDS, "services"))).alias("offers"))
    rows = sample.where(F.col("place") <= cases).join(own, "source_record_id", "left")
    return rows.select(F.lit(False).alias("approved"), "source_record_id", F.col("url").alias("source_url"), "city", F.coalesce(F.size("offers"), F.lit(0)).alias("expected_offer_count"), "offers", F.lit("").alias("review_note"))
