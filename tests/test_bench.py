"""bench.py prints one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="popular,genre_share", BENCH_WARMUP_DIR="none")
    res = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and "errors" not in d
    assert set(d["queries"]) == {"ingest", "popular", "genre_share"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6
