"""Registered queries, their oracles, and the pipeline against brute force."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from reelstat.llm.common import PLACE, masks, placed, scratch, stored, table, without
from reelstat.llm.exact_dedup import exact_dedup
from reelstat.llm.minhash import near_duplicates
from reelstat.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name])
    assert got.columns == want.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = [set(rows)]
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "test-pipeline")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append({r["doc_id"] for r in docs.collect()})
        if name == "exact dedup":
            texts = {" ".join(rows[i].split()) for i in seen[-2]}
            assert len(seen[-1]) == len(texts) and {" ".join(rows[i].split()) for i in seen[-1]} == texts
            assert all(r["kept"] for r in exact_dedup(docs).collect())
        if name == "minhash near-dedup":
            assert all(r["kept"] for r in near_duplicates(docs).collect())
    assert all(a >= b for a, b in zip(seen, seen[1:])) and len(seen[1]) < len(seen[0])
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == seen[-1] and all(r["length"] <= 1024 for r in packed)
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "minhash near-dedup", "mixing sources to target weights",
                                       "best-fit packing"]


def test_pipeline_odd_rows(spark, odd, odd_rows):
    kept = P.drop_exact_copies(spark, odd, SF).collect()
    assert len(kept) == len({plain(r[1]) for r in odd_rows})
    near = P.drop_near_copies(spark, odd, SF)
    assert near.columns == odd.columns and near.count() > 40


def test_pipeline_drops_near_copies_from_four_fifths(spark):
    """Pairs of 100 shingles each of which the last k differ: a similarity of (100 - k) / (100 + k)."""
    docs = []
    for i, k in enumerate([9, 10, 11, 11, 12, 30]):     # 0.835, 0.818, 0.802, 0.802, 0.786, 0.538
        base = [f"w{i}x{j}" for j in range(104)]
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:104 - k], *(f"{w}y" for w in base[104 - k:])]))]
    kept = P.drop_near_copies(spark, spark.createDataFrame(docs, "doc_id long, text string"), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2, 4, 6, 8, 9, 10, 11]


def plain(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("case", ["odd", "empty", "no labels"])
def test_pipeline_chain_on_odd_tables(spark, odd, none, tmp_path, case):
    """All stages in a row, as ``run`` chains them."""
    docs = none if case == "empty" else odd
    sf = str(tmp_path)
    labels = table(spark, SF, "labels")
    (labels.limit(0) if case == "no labels" else labels).write.parquet(f"{sf}/labels.parquet")
    docs.write.parquet(f"{sf}/documents.parquet")
    docs, seen = table(spark, sf, "documents"), []
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, sf), "test-chain")
        seen.append(docs.count())
    assert (seen == [0] * 5) if case == "empty" else (seen[0] >= seen[1] >= seen[2] > 40 and seen[4] >= seen[3] > 40)


def test_dedup_stages_move_no_texts(spark):
    """The verdicts come back as masks: the plan that filters texts shuffles none of them."""
    docs = table(spark, SF, "documents")
    for stage in (P.drop_exact_copies, P.drop_near_copies):
        plan = stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_masks_mark_rows_exactly(spark, tmp_path):
    spark.range(0, 30_000, 1, 3).selectExpr("id", "concat('t', id) AS text").write.parquet(f"{tmp_path}/t")
    rows = placed(spark.read.parquet(f"{tmp_path}/t"))
    gone = [0, 63, 64, 4095, 4096, 9_999, 10_000, 29_999, *range(17_000, 17_300)]
    marked = stored(masks(rows.where(F.col("id").isin(gone)).select(*PLACE)), "test-masks")
    left = without(rows, marked)
    assert left.columns == ["id", "text"] and {r["id"] for r in left.collect()} == set(range(30_000)) - set(gone)
    none = stored(masks(rows.limit(0).select(*PLACE)), "test-masks")
    assert without(rows, none).count() == 30_000


def test_scratch_deletes_what_is_not_kept(spark):
    with scratch(spark) as keep:
        one, two = keep(stored(spark.range(3), "test")), stored(spark.range(4), "test")
        assert two.count() == 4
    assert one.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(two._stored_at)
