"""Command line: the batch report run and the ad-click stream jobs.

    python -m clickscope offline --path /warehouse/shop --out /reports \\
        --start-date 2019-03-15 --end-date 2019-03-30 --start-age 20 --end-age 50 \\
        --flow 1,2,3,4,5,6,7
    python -m clickscope realtime --kafka broker:9092 --topic ads_log \\
        --out /serving/ads --checkpoint hdfs:///ck/ads

Outputs of ``offline`` are Parquet folders under ``--out`` (or JDBC tables
with ``--jdbc-url``); ``realtime`` writes the serving tables described in
``clickscope.streaming.ads_jobs``.  The session comes from the environment
(``spark-submit`` settings); nothing here sets a master.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from clickscope.config import BLACKLIST_THRESHOLD, OTHER_LABEL, REPORT_TABLES, Condition


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickscope")
    sub = p.add_subparsers(dest="cmd", required=True)

    off = sub.add_parser("offline", help="filter the action log and write the four batch reports")
    src = off.add_mutually_exclusive_group(required=True)
    src.add_argument("--database", help="catalog database holding the four tables")
    src.add_argument("--path", help="folder holding the four tables as Parquet")
    off.add_argument("--out", help="folder for the report tables")
    off.add_argument("--jdbc-url", help="write the reports to this JDBC database instead")
    off.add_argument("--jdbc-user")
    off.add_argument("--jdbc-password")
    off.add_argument("--task-id")
    off.add_argument("--other-label", default=OTHER_LABEL)
    for name in ("start-date", "end-date", "professionals", "city", "gender", "keywords", "category-ids"):
        off.add_argument(f"--{name}", default="")
    off.add_argument("--start-age", type=int, default=0)
    off.add_argument("--end-age", type=int, default=0)
    off.add_argument("--flow", default="", help="target page flow, e.g. 1,2,3,4,5,6,7")

    rt = sub.add_parser("realtime", help="run the ad-click stream jobs")
    s = rt.add_mutually_exclusive_group(required=True)
    s.add_argument("--kafka", help="bootstrap servers")
    s.add_argument("--text-path", help="folder of CSV text files (one record per line)")
    rt.add_argument("--topic", default="ads_log")
    rt.add_argument("--out", required=True, help="root folder of the serving tables")
    rt.add_argument("--checkpoint", required=True, help="root folder of the query checkpoints (shared)")
    rt.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD)
    rt.add_argument("--blacklist-mode", choices=["batch", "row"], default="batch")
    rt.add_argument("--counts-mode", choices=["complete", "update"], default="update")
    rt.add_argument("--day-watermark", help="with --no-filter: drop the state of days that began so long ago, e.g. '2 days'")
    rt.add_argument("--starting-offsets", default="latest", help="latest, earliest or Kafka's JSON of offsets")
    rt.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE",
                    help="further source or kafka.* consumer setting (repeatable)")
    rt.add_argument("--max-offsets-per-trigger", type=int, help="bound a micro-batch (with the snapshot blacklist this moves its cuts)")
    rt.add_argument("--max-files-per-trigger", type=int, help="the same for --text-path")
    rt.add_argument("--allow-data-loss", action="store_true", help="go on if offsets have expired meanwhile")
    rt.add_argument("--reset", action="store_true", help="start fresh serving tables under a new checkpoint")
    rt.add_argument("--no-filter", action="store_true", help="count all clicks, not only those passing")
    rt.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    return p


def run_offline(spark: SparkSession, a: argparse.Namespace) -> str:
    from clickscope.plans.reports import ReportTargets, run_reports
    from clickscope.sinks.tables import JdbcTarget
    from clickscope.sources.tables import load_tables

    cond = Condition(start_date=a.start_date, end_date=a.end_date, start_age=a.start_age,
                     end_age=a.end_age, professionals=a.professionals, city=a.city, gender=a.gender,
                     keywords=a.keywords, category_ids=a.category_ids, target_page_flow=a.flow)
    names = REPORT_TABLES
    if a.jdbc_url:
        t = [JdbcTarget(a.jdbc_url, n, user=a.jdbc_user, password=a.jdbc_password) for n in names]
    elif a.out:
        t = [f"{a.out.rstrip('/')}/{n}" for n in names]
    else:
        raise SystemExit("give --out or --jdbc-url")
    model = load_tables(spark, database=a.database, path=a.path)
    return run_reports(model, cond, ReportTargets(*t), task_id=a.task_id, other_label=a.other_label)


def run_realtime(spark: SparkSession, a: argparse.Namespace):
    from clickscope.sources.ads_log import kafka_ads_stream, parse_ads_log, text_ads_stream
    from clickscope.streaming.ads_jobs import AVAILABLE_NOW, Trigger, start_ads_jobs

    if a.kafka:
        lines = kafka_ads_stream(spark, a.kafka, a.topic, starting_offsets=a.starting_offsets,
                                 max_offsets_per_trigger=a.max_offsets_per_trigger,
                                 fail_on_data_loss=not a.allow_data_loss,
                                 options=dict(o.split("=", 1) for o in a.kafka_option))
    else:
        lines = text_ads_stream(spark, a.text_path, max_files_per_trigger=a.max_files_per_trigger)
    clicks, rejects = parse_ads_log(lines)
    trigger = AVAILABLE_NOW if a.available_now else Trigger()
    queries = start_ads_jobs(clicks, a.out, a.checkpoint, rejects=rejects, threshold=a.threshold,
                             blacklist_mode=a.blacklist_mode, filter_blacklisted=not a.no_filter,
                             counts_mode=a.counts_mode, day_watermark=a.day_watermark, trigger=trigger, reset=a.reset)
    for q in queries:
        q.awaitTermination()
    return queries


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"clickscope-{a.cmd}").getOrCreate()
    if a.cmd == "offline":
        task = run_offline(spark, a)
        print(f"task_id={task}")
        return task
    return run_realtime(spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
