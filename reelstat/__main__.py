"""Command line: python -m reelstat <job> ...   (jobs: clean, analyze, recommend, warehouse)

Uses the session of ``spark-submit`` (or a local one when run plainly).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reelstat.plans import jobs
from reelstat.session import RESULT_CONF, ensure_checkpoint_dir
from reelstat.sources import files


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="reelstat")
    sub = ap.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--ratings", required=True)
    c.add_argument("--movies", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--format", default="csv")
    c.add_argument("--tz", default=None)
    for name in ("analyze", "recommend", "warehouse"):
        p = sub.add_parser(name)
        p.add_argument("--ratings", required=True, help="cleaned ratings directory")
        p.add_argument("--movies", required=True, help="cleaned movies directory")
        p.add_argument("--out", required=name != "warehouse")
        p.add_argument("--format", default="csv")
        if name != "recommend":
            p.add_argument("--min-count", type=int, default=None,
                           help="rating-count threshold (defaults: 50 analyze, 100 warehouse)")
        if name == "warehouse":
            p.add_argument("--min-avg", type=float, default=4.0, help="mean threshold of high_score")
            p.add_argument("--refresh", action="store_true", help="overwrite movie_stats if present")
            p.add_argument("--table-dir", default="movie_stats", help="location of movie_stats")
    a = ap.parse_args(argv)

    builder = SparkSession.builder.appName(f"reelstat-{a.job}")
    spark = builder.getOrCreate()
    for k, v in RESULT_CONF.items():     # dates in UTC; clean --tz names another zone
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    if a.job == "clean":
        print(jobs.clean_job(spark, a.ratings, a.movies, a.out, a.format, a.tz))
        return
    r = files.read_ratings_clean(spark, a.ratings, fmt=a.format)
    m = files.read_movies_clean(spark, a.movies, fmt=a.format)
    if a.job == "analyze":
        print(jobs.analysis_job(spark, r, m, a.out, a.format, min_count=a.min_count or 50))
    elif a.job == "recommend":
        print(jobs.recommend_job(spark, r, m, a.out))
    else:
        results = jobs.warehouse_job(spark, a.ratings, a.movies, a.out, a.format, refresh=a.refresh,
                                     table_dir=a.table_dir, min_count=a.min_count or 100,
                                     min_avg=a.min_avg)
        for name, df in results.items():
            print(name)
            df.show(20, truncate=False)


if __name__ == "__main__":
    main()
