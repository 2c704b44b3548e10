"""Command line for the jobs (``spark-submit`` or ``python -m letramento``).

  bronze  --raw TABLE=PATH ... --bronze ROOT
  silver  --bronze ROOT --silver ROOT [--batch-day YYYY-MM-DD]
  gold    --silver ROOT --gold ROOT [--years 2024 ...]
  quality --silver ROOT [--fail-on-error]
  ingest  --inbox PATH --bronze ROOT --checkpoint PATH [--every "1 minute"]
  refresh --inbox PATH --root ROOT

Each job is a separate Spark application; layers meet only through Parquet.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session(name: str) -> SparkSession:
    spark = SparkSession.builder.appName(f"letramento-{name}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _bound(a: argparse.Namespace) -> dict:
    return {"maxFilesPerTrigger": a.max_files} if a.max_files else {}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="letramento")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--raw", nargs="+", required=True, help="TABLE=PATH pairs")
    b.add_argument("--bronze", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--batch-day", default="2026-07-09")
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--years", type=int, nargs="*", default=None, help="recompute only these years")
    q = sub.add_parser("quality")
    q.add_argument("--silver", required=True)
    q.add_argument("--fail-on-error", action="store_true")
    i = sub.add_parser("ingest")
    i.add_argument("--inbox", required=True)
    i.add_argument("--bronze", required=True)
    i.add_argument("--checkpoint", default=None, help="default: the sink's own, beside it")
    i.add_argument("--max-files", default=None, help="most files of a micro-batch")
    i.add_argument("--every", default=None, help="processing-time trigger; default: availableNow")
    r = sub.add_parser("refresh")
    r.add_argument("--inbox", required=True)
    r.add_argument("--root", required=True)
    r.add_argument("--batch-day", default="2026-07-09")
    r.add_argument("--max-files", default=None, help="most files of a micro-batch")
    a = p.parse_args(argv)
    spark = _session(a.job)

    if a.job == "bronze":
        from .plans.bronze import run_bronze
        print(run_bronze(spark, dict(x.split("=", 1) for x in a.raw), a.bronze))
    elif a.job == "silver":
        from .plans.silver import run_silver
        print(run_silver(spark, a.bronze, a.silver, a.batch_day))
    elif a.job == "gold":
        from .plans.gold import run_gold
        print(run_gold(spark, a.silver, a.gold, years=a.years))
    elif a.job == "quality":
        from .operators.quality import assert_quality, quality_report
        from .plans.validation import silver_checks
        results = silver_checks(spark, a.silver).cache()
        results.show(100, truncate=False)
        quality_report(results).show(truncate=False)
        if a.fail_on_error:
            assert_quality(results)
    elif a.job == "ingest":
        from .plans.bronze import STUDENT_STREAM_TABLE
        from .streaming.events import read_envelope_stream, run_until_done, start_ingest
        query = start_ingest(read_envelope_stream(spark, a.inbox, **_bound(a)), f"{a.bronze.rstrip('/')}/{STUDENT_STREAM_TABLE}",
                             a.checkpoint, available_now=a.every is None, processing_time=a.every)
        run_until_done(query)
    elif a.job == "refresh":
        from .plans.pipeline import refresh_students
        print(refresh_students(spark, a.inbox, a.root, a.batch_day, **_bound(a)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
