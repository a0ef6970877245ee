"""Routes that once answered from the wrong data, or differently on other machines."""

import inspect
import os
import shutil
import subprocess
import sys

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reelstat.functions import round_half_up
from reelstat.operators import clean, recommend, similarity
from reelstat.plans import jobs, registry, warehouse_sql
from reelstat.sources import cached, read_movies_clean, register_external, schemas, write_table

SF = "/root/testdata/sf0.001"
FIT = """
import sys
from reelstat.operators import recommend
from reelstat.session import build_session
spark = build_session(sys.argv[1], shuffle_partitions=4)
rows = [(u, i, float((u * i) % 10 + 1) / 2) for u in range(40) for i in range(30) if (u + i) % 3]
model = recommend.fit_als(spark.createDataFrame(rows, "userId int, movieId int, rating double"), rank=3, max_iter=3)
print("FACTORS", sorted((r["id"], [round(x, 6) for x in r["features"]]) for r in model.itemFactors.collect()))
"""


def test_model_does_not_depend_on_cores():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = {subprocess.run([sys.executable, "-c", FIT, f"local[{n}]"], cwd=root, capture_output=True, text=True,
                          timeout=300).stdout.partition("FACTORS")[2] for n in (2, 7)}
    assert len(out) == 1 and out.pop().strip()


def test_fit_defaults():
    args = inspect.signature(recommend.fit_als).parameters
    assert args["num_blocks"].default == 10 and args["checkpoint_interval"].default < args["max_iter"].default


def test_folders_of_one_name_and_changed_sources(spark, tmp_dir):
    a, b = f"{tmp_dir}/a/sf", f"{tmp_dir}/b/sf"
    for folder in (a, b):
        os.makedirs(folder)
        for name in ("lineitem", "orders", "part"):
            shutil.copyfile(f"{SF}/{name}.parquet", f"{folder}/{name}.parquet")
    few = pq.read_table(f"{SF}/lineitem.parquet").slice(0, 100)
    pq.write_table(few, f"{b}/lineitem.parquet")
    total = lambda d: registry.QUERIES["overall_summary"](spark, d).first()["total_ratings"]
    assert [total(a), total(b), total(a)] == [pq.read_metadata(f"{SF}/lineitem.parquet").num_rows, 100, total(a)]
    pq.write_table(few.slice(0, 60), f"{b}/lineitem.parquet")
    assert total(b) == 60


def _clean_folder(spark, path, n):
    rows = [(u % 9, u % 4, 3.0, "2020-01-01") for u in range(n)]
    write_table(spark.createDataFrame(rows, schemas.RATINGS_CLEAN), f"{path}/r", fmt="csv")
    write_table(spark.createDataFrame([(i, f"m{i}", "2000", "A", "A") for i in range(4)], schemas.MOVIES_CLEAN),
                f"{path}/m", fmt="csv")


def test_warehouse_job_reads_its_folders(spark, tmp_dir):
    everything = registry.ingest(spark, SF)
    for table, df in zip(("ratings_ext", "movies_ext"), everything):       # views of the same names
        df.createOrReplaceTempView(table)
    try:
        for n in (50, 70):
            _clean_folder(spark, f"{tmp_dir}/{n}", n)
            out = jobs.warehouse_job(spark, f"{tmp_dir}/{n}/r", f"{tmp_dir}/{n}/m", refresh=True,
                                     table_dir=f"{tmp_dir}/stats", min_count=1)
            assert out["rating_distribution_pct"].first()["cnt"] == n
            assert warehouse_sql.run(spark, "rating_distribution_pct").first()["cnt"] == n      # default names
            assert sum(r["rating_cnt"] for r in out["movie_stats_top"].collect()) == n
    finally:
        spark.catalog.dropTempView("ratings_ext")
        spark.catalog.dropTempView("movies_ext")
    with pytest.raises(ValueError, match="already lies"):
        register_external(spark, "ratings_ext", f"{tmp_dir}/50/r", schemas.RATINGS_CLEAN)


def test_earlier_result_survives_a_second_call(spark):
    query = registry.QUERIES["sql_movie_stats_top"]
    first = query(spark, SF)
    query(spark, SF).collect()
    assert len(first.collect()) == 10


def test_cached_keeps_the_callers_cache(spark):
    mine, other = spark.range(10).persist(), spark.range(11)
    with cached(mine, other):
        assert other.storageLevel.useMemory
    assert mine.storageLevel.useMemory and not other.storageLevel.useMemory
    mine.unpersist()


@pytest.mark.parametrize("kind,value,ok", [("string", "12", True), ("string", "12.5", False), ("double", 3.0, True),
                                           ("double", 3.5, False), ("long", 1 << 40, False), ("string", "x", False)])
def test_ids(spark, kind, value, ok):
    df = spark.createDataFrame([(value, value, 4.0)], f"userId {kind}, movieId {kind}, rating double")
    if ok:
        got = recommend.to_als_input(df)
        assert dict(got.dtypes)["userId"] == "int" and got.first()["movieId"] == int(float(value))
    else:
        with pytest.raises(Exception, match="no int"):
            recommend.to_als_input(df).collect()


def test_step_keeps_all_tenths(spark):
    tenths = [(1, 1, k / 10, 0) for k in range(5, 51)] + [(1, 1, 0.55, 0), (1, 1, 4.999, 0)]
    raw = spark.createDataFrame(tenths, "userId int, movieId int, rating double, timestamp long")
    assert clean.clean_ratings(raw, step=0.1).count() == 46


def test_rounds_once(spark):
    row = spark.range(1).select(*[round_half_up(F.lit(x), 2).alias(str(i)) for i, x in enumerate(
        [2.4949999999, 1.005, 2.675, 1e13 + 0.25])]).first()
    assert list(row) == [2.49, 1.01, 2.68, 1e13 + 0.25]


def test_empty_year_survives_csv(spark, tmp_dir):
    write_table(spark.createDataFrame([(1, "t", "", "A", "A"), (2, "u", None, "A", "A")], schemas.MOVIES_CLEAN),
                f"{tmp_dir}/m", fmt="csv")
    got = {r["movieId"]: r["year"] for r in read_movies_clean(spark, f"{tmp_dir}/m").collect()}
    assert got == {1: "", 2: None}


@pytest.mark.parametrize("block_rows,tasks", [(32768, 96), (300, 96), (300, 5), (1000, 7)])
def test_top_k_for_any_blocks(spark, block_rows, tasks):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(900, 6)).round(2)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "id long, features array<double>")
    got = {}
    for r in similarity.block_top_k(df, 3, block_rows=block_rows, tasks=tasks).collect():
        got.setdefault(r["i"], {})[r["rank"]] = r["j"]
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    score = unit @ unit.T
    np.fill_diagonal(score, -9)
    for i in range(0, 900, 37):
        best = sorted(range(900), key=lambda j: (-round(score[i, j], 12), j))[:3]
        assert [round(score[i, got[i][k]], 9) for k in (1, 2, 3)] == [round(score[i, j], 9) for j in best]


def test_block_pairs_are_dealt_evenly(spark):
    """24 pairs over 24 partitions: one each, whatever their hashes; and one shuffle."""
    v = spark.range(6 * 1024).selectExpr("id", "array(double(id % 7), double(id % 5)) AS features")
    left, right = v.where("id < 4 * 1024"), v.where("id >= 4 * 1024")
    df = similarity.block_top_k(left, 2, right, exclude_self=False, block_rows=400, tasks=24)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("ReusedExchange") <= 2      # the deal and the merge by row
    kernel = similarity.pair_task

    def spy(*args):
        def partition(key, table):
            import pyarrow as pa
            from pyspark import TaskContext

            return pa.table({"i": pa.array([TaskContext.get().partitionId()], pa.int64()), "j": pa.array([0], pa.int64()),
                             "score": pa.array([0.0]), "rank": pa.array([1], pa.int32())})
        return partition

    similarity.pair_task = spy
    try:
        seen = [r["i"] for r in similarity.block_top_k(left, 99, right, exclude_self=False, block_rows=400, tasks=66).collect()]
    finally:
        similarity.pair_task = kernel
    assert seen and max(np.bincount(seen)) <= 1 + len(seen) // 66


def test_unbounded_results_stay_split():
    assert "high_score" not in jobs.BOUNDED and "user_activity" not in jobs.BOUNDED
