"""Running sums and dealing where rows tie, the mix as a queue of words, and
Python workers of a job that wasn't started inside the repository."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirrus.llm import common, mixing, topk
from tests.conftest import SF_SMALL

REPO = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("key", [None, "k"])
def test_running_sum_of_rows_that_tie(spark, monkeypatch, key):
    """Equal rows, a hot key and null keys: ranges are even, sums exact."""
    n, seen, old = 20_000, [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, name: seen.append(old(df, name)) or seen[-1])
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("hot")).alias("k"), F.lit(0).alias("o"), F.lit(2).cast("long").alias("v"))
    got = common.running_sum(old(rows, "rows"), [key] if key else [], [F.col("o")], "v", "s").collect()
    sums = Counter((r[key] if key else 0, r.s) for r in got)
    sizes = Counter(r[key] if key else 0 for r in got)
    assert set(sums.values()) == {1} and all((k, 2 * i) in sums for k, m in sizes.items() for i in range(m))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in seen[0].groupBy("_range").count().collect()) < 3 * n / width


def test_candidates_of_one_id_are_dealt_to_all_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 1000)
    seen, old = [], topk.stored
    monkeypatch.setattr(topk, "stored", lambda df, name: seen.append(old(df, name)) or seen[-1])
    df = spark.range(5000).select(F.lit(3).alias("vec_id"), F.array(F.lit(0.5), F.lit(0.25)).alias("embedding")).union(spark.createDataFrame([(20, [1.0, 1.0])], "vec_id long, embedding array<double>"))
    assert topk.top_k(df, df.vec_id % 20 == 0, k=3).count() == 3
    shards = Counter(r["deal"] % 6 for r in seen[0].select("deal").collect())
    assert len(shards) == 6 and max(shards.values()) < 1200


def test_mix_is_the_queue_of_words_cut_at_the_budget(spark):
    """Every word of every source gets its finish time, place over target;
    all words sorted by it and cut at the budget are those that are taken."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 40))), ["a", "b", None, "d"][int(rng.integers(4))]) for i in range(200)]
    rows += [(900, "w " * 700, "e"), (901, "", "f"), (None, "w w w", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    copies = mixing.queue(docs).collect()
    targets = {r.source: None for r in docs.select("source").distinct().collect()}
    told = {(r.doc_id, r.size): (r.target, r.source_size) for r in got}
    words = []
    for source in targets:
        mine = [r for r in copies if r.source == source]
        if mine:
            target = told[mine[0].doc_id, mine[0].size][0]
            mine.sort(key=lambda r: r.start)
            place = 0
            for r in mine:
                words += [((place + j + 1) / target, source, r.doc_id, r.copy) for j in range(r.size)]
                place += r.size
    budget = sum(int(t) for t in {r.source: told[r.doc_id, r.size][0] for r in copies}.values())
    cut = Counter((w[2], w[3]) for w in sorted(words, key=lambda w: w[0])[:budget])
    assert cut == Counter({(r.doc_id, r.copy): r.taken for r in copies})
    assert sum(r.taken for r in got) == budget and all(r.taken <= 2 * r.size for r in got)


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from cirrus.session import build_session
import __spark_entry__ as entry
from cirrus.sources.raw import read_raw
spark = build_session(master="local[4]", shuffle_partitions=4)
assert read_raw(spark, {raw!r}).count() == 2
for name in {names!r}:
    print(name, entry.queries()[name](spark, {sf!r}).count(), flush=True)
"""


@pytest.mark.parametrize("names", [["op1_top_k", "op3_near_dedup", "op4_quality_rules", "op5_secret_scan", "op7_token_counts"], ["op9_toxicity", "op10_packing", "op11_token_ids", "op12_clusters", "op13_phrases"], ["pipeline"]])
def test_workers_get_the_package(tmp_path, names):
    """The job starts in another folder, without PYTHONPATH."""
    (tmp_path / "raw" / "1901").mkdir(parents=True)
    (tmp_path / "raw" / "1901" / "s.csv").write_text("header\na\nb\n")
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(repo=str(REPO), raw=str(tmp_path / "raw"), names=names, sf=SF_SMALL))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")} | {"CIRRUS_DRIVER_MEMORY": "4g"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.strip()] == names
