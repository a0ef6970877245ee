import hashlib
import re

import pytest

from reelstat.llm.exact_dedup import exact_dedup, text_identities


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("block", [8192, 7])
def test_equals_brute_force(odd, odd_rows, block):
    got = exact_dedup(odd, block_bytes=block).collect()
    groups = {}
    for r in odd_rows:
        groups.setdefault(plain(r[1]), []).append(r[0])
    want = []
    for text, ids in groups.items():
        first = min((x for x in ids if x is not None), default=None)
        done = False
        for i in ids:
            kept = i == first and not done
            done |= kept
            want.append((i, first, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_names_are_deterministic_and_free_of_collisions(odd):
    a, b = ({(r["doc_id"], r["text_sha256"]): (r["size"], r["name"]) for r in text_identities(docs, block_bytes=16).collect()}
            for docs in (odd, odd.repartition(5)))
    assert a == b
    by_hash = {}
    for (_, sha), identity in a.items():
        by_hash.setdefault(sha, set()).add(identity)
    assert all(len(x) == 1 for x in by_hash.values()) and len({*map(tuple, by_hash.values())}) == len(by_hash)


def test_hot_group(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the same  text', concat('text ', id)) AS text")
    got = {r["doc_id"]: r for r in exact_dedup(docs, block_bytes=4).collect()}
    assert len(got) == 3000 and got[2997]["keep_id"] == 0 and got[2997]["group_size"] == 1000
    assert sum(r["kept"] for r in got.values()) == 2001


def test_empty_table(none):
    assert exact_dedup(none).collect() == []
