"""What Python processes keep between the tasks of a pipeline's stages, and
what near duplicates leave on disk and ask of the scheduler."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa

from cirrus.llm import bytebpe, neardup, packing
from cirrus.llm.common import passing_tables, stored
from cirrus.llm.queries import tokenizer_path
from cirrus.session import checkpoint_root


def _batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])


def test_tasks_give_freed_memory_back(monkeypatch):
    given = []
    for module in (packing, neardup):
        monkeypatch.setattr(module, "give_back", lambda name=module.__name__: given.append(name))
    texts = ["one two three four five six", None, "", "one two three four five seven"]
    pieces = list(packing._cut(tokenizer_path(), 2048, 0)(iter([_batch(texts)])))
    assert sum(b.num_rows for b in pieces) == 4
    assert given == ["cirrus.llm.packing"]
    assert sum(b.num_rows for b in neardup._signed(iter([_batch(texts)]))) == 4
    assert given == ["cirrus.llm.packing", "cirrus.llm.neardup"]


def test_remembered_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    monkeypatch.setattr(packing, "_KNOWN", {})
    known = packing.remembered(tokenizer_path())
    for k in range(20):
        known.of(" ".join(f"w{k}x{i}" for i in range(40)))
        assert len(known) <= 50 + 40 and len(known.before) <= 50 + 40


def test_parts_that_come_once_are_not_kept(monkeypatch):
    monkeypatch.setattr(packing, "_KNOWN", {})
    known = packing.remembered(tokenizer_path())
    want = known.of("alpha beta, g\u00e9mma")
    assert not known
    assert known.of("alpha beta, g\u00e9mma") == want and set(known) == {" alpha", "beta,", "g\u00e9mma"}
    assert known.of("alpha beta, g\u00e9mma") == want


def test_a_new_word_takes_one_call(monkeypatch):
    """A word, perhaps with marks, is neither cut by the pattern nor kept twice."""
    bpe = bytebpe.ByteBpe(tokenizer_path())
    words = ["w\u00f6rd", "word", "word,", "w\u00f6rd...)", "\u0436\u0437;"]
    want = [b"".join(bpe.known[t] for t in bpe.pretokens_of(w)) for w in words]
    bpe.known.clear()
    monkeypatch.setattr(bpe, "pretokens_of", lambda part: 1 / 0)
    assert [bpe.ids_of(w) for w in words] == want
    assert not any(c.isalpha() for t in bpe.known for c in t)


def _stored_tables(spark):
    root = checkpoint_root(spark)
    at = f"/{root.removeprefix('file:').lstrip('/')}/cirrus-llm"
    return {x for x in os.listdir(at) if os.path.exists(f"{at}/{x}/_SUCCESS")} if os.path.isdir(at) else set()


def test_passing_tables_go(spark):
    before = _stored_tables(spark)
    with passing_tables() as keep:
        with passing_tables() as keep_inside:
            a, _ = keep_inside(stored(spark.range(3), "a")), stored(spark.range(4), "b")
        c = keep(stored(a.unionByName(spark.range(5)), "c"))
        assert len(_stored_tables(spark) - before) == 2
    assert c.count() == 8 and len(_stored_tables(spark) - before) == 1


def test_components_leave_two_tables(spark, docs):
    before = _stored_tables(spark)
    out = neardup.components(docs)
    left = sorted(x.rsplit("-", 1)[0] for x in _stored_tables(spark) - before)
    assert left == ["components", "signed"] and out.count() == docs.count()


def test_few_links_are_merged_without_shuffles(spark):
    """Tasks don't follow the number of shuffle partitions a round; whether a
    round runs in one task makes no difference to its result."""
    edges = stored(spark.createDataFrame([(i * 7919 % 300, (i + 1) * 7919 % 300) for i in range(299)] + [(900, 901)], "a long, b long"), "few")
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old, few, tasks, got = {k: spark.conf.get(k) for k in conf}, neardup.FEW_LINKS, [], []
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for neardup.FEW_LINKS in (few, 0):
            spark.sparkContext.setJobGroup(group := uuid.uuid4().hex, group)
            got.append({r.id: r.root for r in neardup.merged(edges).collect()})
            told = spark.sparkContext.statusTracker()
            stages = {s for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds}
            tasks.append(sum(i.numCompletedTasks for i in map(told.getStageInfo, stages) if i))
    finally:
        neardup.FEW_LINKS = few
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got[0] == got[1] == {i: 0 for i in range(300)} | {900: 900, 901: 900}
    assert 3 * tasks[0] < tasks[1], tasks
