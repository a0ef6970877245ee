"""External tables, materialised aggregates and caching."""

import os

from reelstat.operators import stats
from reelstat.plans import warehouse_sql
from reelstat.sources import cached, files, materialize, register_external, schemas, testdata

SF = "/root/testdata/sf0.001"


def test_external_tables_and_sql_route(spark, tmp_dir):
    r, m = testdata.ratings(spark, SF), testdata.movies(spark, SF)
    rdir, mdir = os.path.join(tmp_dir, "ratings"), os.path.join(tmp_dir, "movies")
    files.write_table(r, rdir, fmt="csv")
    files.write_table(m, mdir, fmt="csv")
    re_ = register_external(spark, "ratings_ext", rdir, schemas.RATINGS_CLEAN, replace=True)
    me = register_external(spark, "movies_ext", mdir, schemas.MOVIES_CLEAN, replace=True)
    assert re_.count() == r.count() and me.count() == m.count()
    desc = {row.col_name: row.data_type for row in spark.sql("DESCRIBE TABLE EXTENDED spark_catalog.default.ratings_ext").collect()}
    assert desc.get("Type") == "EXTERNAL"
    a = warehouse_sql.run(spark, "genre_avg", min_count=50).collect()
    b = stats.genre_avg(r, m, min_count=50).collect()
    assert a == b
    # a leftover view of the same name cannot stand in for the table
    r.limit(1).createOrReplaceTempView("ratings_ext")
    try:
        assert warehouse_sql.run(spark, "genre_avg", min_count=50).collect() == b
    finally:
        spark.catalog.dropTempView("ratings_ext")
    spark.sql("DROP TABLE spark_catalog.default.ratings_ext")
    spark.sql("DROP TABLE spark_catalog.default.movies_ext")
    assert files.read_ratings_clean(spark, rdir).count() == r.count()   # files survive DROP


def test_materialize_ignore_and_overwrite(spark):
    r, m = testdata.ratings(spark, SF), testdata.movies(spark, SF)
    spark.sql("DROP TABLE IF EXISTS movie_stats")
    ms = stats.movie_stats(r, m)
    t = materialize(ms, "movie_stats")
    n = t.count()
    assert n == ms.count()
    # IF NOT EXISTS semantics: a second run keeps the old rows
    materialize(ms.limit(3), "movie_stats", mode="ignore")
    assert spark.table("movie_stats").count() == n
    materialize(ms.limit(3), "movie_stats", mode="overwrite")
    assert spark.table("movie_stats").count() == 3
    materialize(ms, "movie_stats", mode="overwrite", bucket_by=(4, "movieId"), sort_by="movieId")
    top_sql = warehouse_sql.run(spark, "movie_stats_top", min_count=30).collect()
    top_df = stats.movie_stats_top(spark.table("movie_stats"), min_count=30).collect()
    assert top_sql == top_df and len(top_df) == 10
    spark.sql("DROP TABLE movie_stats")


def test_cached_context(spark):
    r = testdata.ratings(spark, SF)
    with cached(r) as c:
        assert c.is_cached
        assert c.count() > 0
    assert not r.is_cached


def test_write_result_single_file(spark, tmp_dir):
    out = os.path.join(tmp_dir, "dist")
    files.write_result(stats.rating_distribution(testdata.ratings(spark, SF)), out, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1


def test_external_table_relative_location(spark, tmp_dir, monkeypatch):
    r = testdata.ratings(spark, SF)
    files.write_table(r, os.path.join(tmp_dir, "rel_ratings"), fmt="csv")
    monkeypatch.chdir(tmp_dir)
    t = register_external(spark, "ratings_rel", "rel_ratings", schemas.RATINGS_CLEAN, replace=True)
    assert t.count() == r.count()
    spark.sql("DROP TABLE ratings_rel")


def test_paths_keep_uri_schemes():
    from reelstat.session import absolute, has_scheme, join_path
    assert absolute("file:/tmp/x") == "file:/tmp/x" and has_scheme("hdfs://nn/x")
    assert absolute("s3a://b/x") == "s3a://b/x" and join_path("file:/tmp", "t") == "file:/tmp/t"
    assert absolute("rel/x") == os.path.abspath("rel/x") and not has_scheme("/tmp/x")
