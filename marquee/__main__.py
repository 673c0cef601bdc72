"""Command line: run the film jobs with ``spark-submit`` or ``python -m marquee``.

    python -m marquee all --metadata movies_metadata.csv \\
        --links links.csv links_small.csv --ratings 'ratings*.csv' \\
        --feed abstracts.xml --out /shared/film [--k 1000] [--ratio decimal]

The session comes from the environment (``spark-submit`` settings, or
``spark-defaults.conf``); nothing is collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from marquee.plans import jobs
from marquee.session import ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="marquee")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("all", help="stage every table, then build top_movies (E6)")
    run.add_argument("--metadata", required=True)
    run.add_argument("--links", required=True, nargs="+")
    run.add_argument("--ratings", required=True, help="path or glob of rating files")
    run.add_argument("--feed", required=True, help="encyclopedia abstract XML")
    run.add_argument("--out", required=True, help="output folder on shared storage")
    run.add_argument("--k", type=int, default=jobs.TOP_K)
    run.add_argument("--ratio", choices=["decimal", "double"], default="decimal")
    run.add_argument("--numerator", default="budget", choices=["budget", "revenue"],
                     help="ratio = numerator / denominator (default budget per revenue)")
    run.add_argument("--denominator", default="revenue", choices=["budget", "revenue"])
    run.add_argument("--enforce-constraints", action="store_true",
                     help="load every table all-or-nothing; refuse on key/check violations")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("marquee").getOrCreate()
    ensure_checkpoint_dir(spark)
    jobs.run_all(spark, args.out, metadata_csv=args.metadata, link_csvs=args.links,
                 ratings_glob=args.ratings, feed_xml=args.feed, k=args.k, ratio_mode=args.ratio,
                 enforce_constraints=args.enforce_constraints, numerator=args.numerator,
                 denominator=args.denominator)


if __name__ == "__main__":
    main()
