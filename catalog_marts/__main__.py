"""Command line: ``spark-submit ... -m catalog_marts`` or ``python -m catalog_marts``.

    python -m catalog_marts build   --raw DUMPS --out ROOT      cleaned tables and marts
    python -m catalog_marts publish --out ROOT --target SERVING  copy to the serving location
    python -m catalog_marts report  --out ROOT                   the four reports, printed
    python -m catalog_marts report  --out ROOT --reports FOLDER  and stored as CSV
"""

from __future__ import annotations

import argparse

from catalog_marts.plans import (
    build_gold,
    build_silver,
    publish,
    raise_on_failure,
    report_q1,
    report_q2,
    report_q3,
    report_q4,
)
from catalog_marts.plans.publish import PARALLELISM, SERVING_TABLES
from catalog_marts.session import get_session
from catalog_marts.sources import register_views, scratch_scope


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="catalog_marts", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=["build", "publish", "report"])
    parser.add_argument("--raw", help="folder with the raw dumps")
    parser.add_argument("--out", required=True, help="root of the silver and gold tables")
    parser.add_argument("--target", help="serving location")
    parser.add_argument("--reports", help="folder that the reports are stored in")
    parser.add_argument("--scratch", help="folder that all executors share, for scratch tables")
    parser.add_argument("--cluster", choices=["range", "hash"], default="range",
                        help="layout of the cleaned tables; hash reads the dumps only once")
    parser.add_argument("--partitions", type=int, help="starting number of shuffle partitions")
    parser.add_argument("--parallelism", type=int, default=PARALLELISM)
    args = parser.parse_args(argv)
    if args.step == "build" and not args.raw:
        parser.error("build needs --raw")
    if args.step == "publish" and not args.target:
        parser.error("publish needs --target")

    shared = {"spark.checkpoint.dir": args.scratch} if args.scratch else {}
    spark = get_session(partitions=args.partitions, **shared)
    if args.step == "build":
        with scratch_scope(spark, "build"):  # fails before the first job if there is no folder
            build_silver(spark, args.raw, args.out, cluster=args.cluster)
            build_gold(spark, args.out)
        return
    register_views(spark, args.out)
    if args.step == "publish":
        tables = {name: spark.table(name) for name in SERVING_TABLES}
        status = publish(spark, tables, args.target, args.parallelism)
        status.show(truncate=False)
        raise_on_failure(status)
        return
    mart = spark.table("gold_category_wise_movies")
    reports = {"q1": report_q1(spark.table("silver_titles"), spark.table("silver_ratings"))}
    reports |= {"q2": report_q2(mart), "q3": report_q3(mart), "q4": report_q4(mart)}
    for name, report in reports.items():
        if args.reports:  # part files are in the order of the report
            report.write.mode("overwrite").option("header", True).csv(f"{args.reports}/{name}")
        print(name, *report.columns, sep="\t")
        for row in report.toLocalIterator():  # all rows, a partition at a time
            print(*row, sep="\t")


if __name__ == "__main__":
    main()
