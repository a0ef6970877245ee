"""The four jobs end to end on small CSV inputs."""

import csv
import os

from reelstat.plans import jobs
from reelstat.sources import files, testdata

SF = "/root/testdata/sf0.001"


def _raw_csvs(spark, tmp_dir):
    r = testdata.raw_ratings(spark, SF).toPandas()
    m = testdata.raw_movies(spark, SF).toPandas()
    m.loc[0, "title"] = 'Quote "x", y (2000)'
    rp, mp = os.path.join(tmp_dir, "ratings.csv"), os.path.join(tmp_dir, "movies.csv")
    r.to_csv(rp, index=False)
    m.to_csv(mp, index=False, quoting=csv.QUOTE_MINIMAL, doublequote=True)
    return rp, mp, len(r), len(m)


def test_clean_analyze_recommend_warehouse(spark, tmp_dir):
    rp, mp, nr, nm = _raw_csvs(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    paths = jobs.clean_job(spark, rp, mp, out)
    r = files.read_ratings_clean(spark, paths["ratings_clean"])
    m = files.read_movies_clean(spark, paths["movies_clean"])
    assert r.count() == nr and m.count() == nm
    assert m.where("title = 'Quote \"x\", y (2000)' and year = '2000'").count() == 1
    s = files.read_csv(spark, paths["data_summary"], spark.read.option("header", True)
                       .option("inferSchema", True).csv(paths["data_summary"]).schema).first()
    assert s.n_ratings == nr

    a = jobs.analysis_job(spark, r, m, os.path.join(tmp_dir, "analysis"), min_count=20)
    for name, p in a.items():
        assert os.path.isdir(p), name
        if name in jobs.BOUNDED:
            assert len([f for f in os.listdir(p) if f.startswith("part-")]) == 1

    w = jobs.warehouse_job(spark, paths["ratings_clean"], paths["movies_clean"], refresh=True,
                           min_count=20, min_avg=3.0)
    assert w["movie_stats_top"].count() == 10
    assert w["rating_distribution_pct"].count() == 10
    spark.sql("DROP TABLE IF EXISTS ratings_ext")
    spark.sql("DROP TABLE IF EXISTS movies_ext")
    spark.sql("DROP TABLE IF EXISTS movie_stats")

    rec = jobs.recommend_job(spark, r, m, os.path.join(tmp_dir, "rec"), rank=4, max_iter=3)
    assert os.path.isdir(rec["model"])
    from reelstat.operators.recommend import split_ratings
    train_users = split_ratings(r)[0].select("userId").distinct().count()
    assert spark.read.parquet(rec["user_recs"]).count() == 5 * train_users


def test_command_line_clean(spark, tmp_dir):
    import subprocess
    import sys
    rp, mp, nr, nm = _raw_csvs(spark, tmp_dir)
    out = os.path.join(tmp_dir, "cli")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)
    res = subprocess.run([sys.executable, "-m", "reelstat", "clean", "--ratings", rp, "--movies", mp,
                          "--out", out, "--format", "parquet"], env=env, capture_output=True,
                         text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert spark.read.parquet(os.path.join(out, "ratings_clean")).count() == nr
    assert spark.read.parquet(os.path.join(out, "data_summary")).first().n_movies == nm
    # warehouse job twice in fresh sessions: relative locations, movie_stats kept then reused
    for _ in range(2):
        res = subprocess.run([sys.executable, "-m", "reelstat", "warehouse",
                              "--ratings", "cli/ratings_clean", "--movies", "cli/movies_clean",
                              "--format", "parquet", "--min-count", "20", "--min-avg", "3.0"],
                             env=env, cwd=tmp_dir, capture_output=True, text=True, timeout=600)
        assert res.returncode == 0, res.stderr[-2000:]
        assert "movie_stats_top" in res.stdout
    assert spark.read.parquet(os.path.join(tmp_dir, "movie_stats")).count() > 0


def test_chart_series(spark):
    r, m = testdata.ratings(spark, SF), testdata.movies(spark, SF)
    series = jobs.chart_series(r, m)
    assert set(series) == {"fig1_rating_distribution", "fig2_popular", "fig3_genre_share", "fig4_year_trend"}
    f1 = [x.rating for x in series["fig1_rating_distribution"].collect()]
    assert f1 == sorted(f1) and len(f1) == 10
    f4 = [x.year for x in series["fig4_year_trend"].collect()]
    assert f4 == sorted(f4) and len(f4) == 15


def test_chart_series_with_model(spark):
    from reelstat.operators import recommend
    r, m = testdata.ratings(spark, SF), testdata.movies(spark, SF)
    train, test = recommend.split_ratings(r)
    model = recommend.fit_als(train, rank=2, max_iter=2)
    f5 = jobs.chart_series(r, m, model, train, test)["fig5_als_metrics"].first()
    assert f5.rmse > 0 and f5.train_n + f5.test_n == r.count()
