"""Commands: run, inspect, diff, quality-check, make-gold-template."""

from __future__ import annotations

import argparse
import json
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    sub = p.add_subparsers(dest="verb", required=True)
    r = sub.add_parser("run", help="normalise a snapshot to offers, errors and statistics")
    for flag in ("--input", "--output"):
        r.add_argument(flag, required=True)
    r.add_argument("--provider")
    r.add_argument("--only-provider")
    r.add_argument("--max-records", type=int)
    r.add_argument("--csv", help="also export the offers to this CSV file")
    i = sub.add_parser("inspect", help="the reduced text of a page")
    i.add_argument("html_file")
    i.add_argument("--city", default="")
    i.add_argument("--max-chars", type=int, default=10_000)
    d = sub.add_parser("diff", help="changes between two card snapshots")
    d.add_argument("old")
    d.add_argument("new")
    d.add_argument("--output")
    q = sub.add_parser("quality-check", help="counters by structural group, gold cases and a decision")
    q.add_argument("--input", required=True)
    q.add_argument("--provider")
    q.add_argument("--gold")
    q.add_argument("--max-records", type=int)
    q.add_argument("--min-positive-records", type=int, default=0)
    q.add_argument("--min-offers", type=int, default=0)
    q.add_argument("--require-gold", action="store_true")
    g = sub.add_parser("make-gold-template", help="unapproved cases for review")
    g.add_argument("--input", required=True)
    g.add_argument("--output", required=True)
    g.add_argument("--provider")
    g.add_argument("--cases", type=int, default=20)
    return p


def _outcomes(spark, a):
    from pyspark.sql import functions as F

    from millrace.functions.html import with_visible_text
    from millrace.operators import quality, sampling
    from millrace.plans.normalize import normalize
    from millrace.sources.snapshots import read_records

    records = read_records(spark, a.input, a.provider, getattr(a, "max_records", None))
    got = normalize(records)
    marks = with_visible_text(records.select("source_record_id", "payload"), "payload").select("source_record_id", quality.independent_signal(F.col("visible")).alias("signal"))
    prints = sampling.fingerprint(records).select("source_record_id", "fingerprint")
    return records, got, got.records.where("not skipped").join(prints, "source_record_id").join(marks, "source_record_id")


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.verb == "inspect":
        from millrace.functions.html import reduced

        with open(a.html_file, encoding="utf-8") as f:
            r = reduced(f.read(), a.city, a.max_chars)
        print(r["text"])
        print(json.dumps({k: v for k, v in r.items() if k != "text"}), file=sys.stderr)
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("millrace").getOrCreate()
    if a.verb == "run":
        from millrace.plans.normalize import normalize
        from millrace.sources import snapshots

        got = normalize(snapshots.read_records(spark, a.input, a.provider, a.max_records), a.only_provider)
        snapshots.write_offers(got.offers, f"{a.output}/offers")
        snapshots.write_errors(got.errors, f"{a.output}/errors")
        stats = got.stats()
        stats.coalesce(1).write.mode("overwrite").json(f"{a.output}/quality")
        if a.csv:
            snapshots.export_csv(got.offers.orderBy("seq", "at").drop("seq", "at"), a.csv)
        total = stats.where("provider is null").first()
        return int(total is not None and total["failed"] > 0)
    if a.verb == "diff":
        from millrace.operators.compare import card_changes
        from millrace.sources.snapshots import load_cards

        out = card_changes(load_cards(spark, a.old), load_cards(spark, a.new))
        if a.output:
            out.write.mode("overwrite").json(a.output)
        else:
            for line in out.toJSON().toLocalIterator():
                print(line)
        return 0
    from millrace.operators import quality, sampling

    records, got, outcomes = _outcomes(spark, a)
    if a.verb == "make-gold-template":
        prints = sampling.fingerprint(records).select("seq", "source_record_id", "url", "city", "fingerprint")
        sample = sampling.stratified(prints, "fingerprint", "seq", train=a.cases, holdout=0, smoke=0)
        quality.gold_template(sample, got.offers, a.cases).coalesce(1).write.mode("overwrite").json(a.output)
        return 0
    approved = pending = failed = missing = 0
    if a.gold:
        cases = quality.load_gold(spark, a.gold)
        matched = quality.matched_cases(cases, records)
        approved, pending = cases.where("approved").count(), cases.where("not coalesce(approved, false)").count()
        missing = quality.missing_cases(cases, matched).count()
        failed = quality.case_differences(matched, got.offers).where("size(differences) > 0").count()
    row = quality.decide(quality.group_counters(outcomes), approved, pending, failed, missing, a.min_positive_records, a.min_offers, a.require_gold).first()
    print(json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))
    return 2 if row["status"] == "failed" else 0


if __name__ == "__main__":
    sys.exit(main())
