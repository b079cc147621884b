"""Registered queries: equal to their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from cirrus.llm.queries import ORACLE, QUERIES
from cirrus.llm.secretscan import base_spans
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF_SMALL)
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    text = lambda rows, columns: sorted(repr([dict(zip(columns, r))[c] for c in order]) for r in rows)
    assert text(got.collect(), got.columns) == text(want.fetchall(), want.columns)


def test_a_query_for_each_operator():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)


def test_pipeline_stages(spark):
    """Each stage's decisions take effect, on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, outs = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        outs.append(stage(spark, outs[-1], SF_SMALL).cache())
    _, good, alone, clean, mixed, packed = outs
    ids = [{r.doc_id for r in o.select("doc_id").collect()} for o in outs]
    assert all(sorted(o.columns) == sorted(columns) for o in outs[1:-1])
    assert ids[0] >= ids[1] >= ids[2] == ids[3] >= ids[4] == ids[5]
    assert alone.count() == len(ids[2]) < good.count() < docs.count()
    assert not any(e - s > 24 for r in clean.collect() for _, s, e in base_spans(r.text))
    assert {r.doc_id: r.text for r in clean.collect() if "[secret]" not in r.text}.items() <= {r.doc_id: r.text for r in alone.collect()}.items()
    assert all(r.n_chars == len(r.text) for r in mixed.collect())
    held = {}
    for r in packed.collect():
        held[r.sequence_id] = held.get(r.sequence_id, 0) + r.length
    assert max(held.values()) <= 2048 and len(held) <= 1.02 * sum(held.values()) / 2048 + 1


def test_pipeline_over_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_pipeline_over_awkward_rows(spark, awkward):
    """Nulls in any column, empty and long texts, ties and repeated rows, and
    a column more: every stage keeps what it should of them."""
    more = " ".join(f"clean{i} words" for i in range(30))
    rows = [(i, t, [None, "en"][k % 2], s, None if k % 3 else len(t or ""), "x") for k, (i, t, s) in enumerate(awkward)]
    rows += [(100, more, None, None, None, None), (100, more, None, None, None, None), (101, more, "en", "s", 1, "y"), (None, more + " more", "en", None, 3, "z"), (102, f'{more} token = "{"0a" * 20}"', "en", "s", 5, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string").repartition(3)
    columns, outs = list(corpus_pipeline.COLUMNS), [docs]
    for _, stage in corpus_pipeline.STAGES:
        outs.append(stage(spark, outs[-1], SF_SMALL).cache())
    whole, good, alone, clean, mixed, packed = [o.collect() for o in outs]
    assert all(sorted(o.columns) == sorted(columns) for o in outs[1:-1])
    texts = lambda rs: [(r.doc_id, r.text) for r in rs]
    assert set(texts(alone)) <= set(texts(good)) <= set(texts(whole)) and all(r.text and len(r.text.split()) >= 10 for r in good)
    ids = [r.doc_id for r in alone if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and {100, 102} - set(ids) in (set(), {102}) and 101 not in ids and None in {r.doc_id for r in alone}
    assert len(clean) == len(alone) and not any("0a0a0a0a" in r.text for r in clean)
    words = lambda rs: sum(len(r.text.split()) for r in rs)
    assert 1.3 * words(clean) <= words(mixed) <= 1.5 * words(clean) and {r.doc_id for r in mixed} <= {r.doc_id for r in clean}
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed} and all(r.length <= 2048 for r in packed)
