"""Column expressions: key hash parity with its SQL text, dates, rounding."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelstat.functions import epoch_to_date, hash_bucket, hash_bucket_sql, round_half_up

INT32 = st.integers(min_value=-(2 ** 31), max_value=2 ** 31 - 1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(INT32, INT32), min_size=1, max_size=200), st.integers(0, 2 ** 31 - 2))
def test_hash_bucket_matches_sql_text(spark, pairs, seed):
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r.h for r in df.select(hash_bucket(["a", "b"], seed, 10000).alias("h")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, a INTEGER, b INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    exp = [r[0] for r in con.execute(
        f"SELECT {hash_bucket_sql(['a', 'b'], seed, 10000)} FROM t ORDER BY i").fetchall()]
    assert got == exp
    assert all(0 <= h < 10000 for h in got)


def test_hash_bucket_is_spread(spark):
    df = spark.range(100_000).select((F.col("id") % 300).cast("int").alias("a"),
                                     (F.col("id") / 300).cast("int").alias("b"))
    counts = [r["count"] for r in df.groupBy(hash_bucket(["a", "b"], 42, 10).alias("h")).count().collect()]
    assert len(counts) == 10 and max(counts) - min(counts) < 0.05 * 10_000


def test_epoch_to_date_zones(spark):
    df = spark.createDataFrame([(964982703,), (1537799250,), (0,), (1710054000,)], "t long")
    utc = [r.d for r in df.select(epoch_to_date("t").alias("d")).collect()]
    assert utc == ["2000-07-30", "2018-09-24", "1970-01-01", "2024-03-10"]
    ny = [r.d for r in df.select(epoch_to_date("t", "America/New_York").alias("d")).collect()]
    assert ny == ["2000-07-30", "2018-09-24", "1969-12-31", "2024-03-10"]


def test_round_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (3.14159,)], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    assert got == [1.01, 2.68, -1.01, 3.14]


TITLE_CHARS = st.sampled_from(list("ab (),'\"-0123456789") + ["(1995)", "(20", "0)", " (2003-2004)"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(TITLE_CHARS, max_size=12).map("".join), min_size=1, max_size=100))
def test_release_year_matches_first_four_digit_group(spark, titles):
    import re
    from reelstat.functions import main_genre, release_year
    df = spark.createDataFrame([(i, t, t.replace(" ", "|")) for i, t in enumerate(titles)],
                               "i int, title string, genres string")
    got = df.select("i", release_year("title").alias("y"), main_genre("genres").alias("g")).collect()
    for r in got:
        m = re.search(r"\((\d{4})\)", titles[r.i], re.ASCII)
        assert r.y == (m.group(1) if m else "")
        assert r.g == titles[r.i].replace(" ", "|").split("|")[0]
