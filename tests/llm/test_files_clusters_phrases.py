"""Token id files, centroid clustering and phrases against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cirrus.llm import centroids, phrases, tokenids
from cirrus.llm.common import numbered, scratch, stored
from cirrus.llm.queries import tokenizer_path
from pyspark.sql import functions as F

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.mark.parametrize("shard_bytes", [2_000, 1 << 30])
def test_token_id_files(spark, docs, awkward, empty, shard_bytes):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    path = scratch(spark, "ids-test")
    manifest = tokenids.write(docs, tokenizer_path(), 2, path, shard_bytes=shard_bytes)
    shards = sorted(manifest.collect(), key=lambda r: r.shard)
    assert (len(shards) > 3) == (shard_bytes < 1 << 20) and sum(r.docs for r in shards) == len(awkward)
    want = Counter()
    for i, text, _ in awkward:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = sorted(tokenids.read(manifest, path).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    flat = []  # the files as somebody else would read them
    for r in shards:
        shard = tokenids.Shard(path, r.file, r.width, r.docs, r.ids)
        assert r.start == len(flat) and isinstance(shard.ids(0, r.ids), np.memmap)
        flat += shard.ids(0, r.ids).tolist()
    for r in got:
        assert zlib.crc32(np.array(flat[r.start : r.start + r.n_tokens], "<u4").tobytes()) == r.ids_crc32
    none = scratch(spark, "ids-none")
    assert tokenids.read(tokenids.write(empty, tokenizer_path(), 2, none), none).count() == 0


def test_token_ids_of_one_hot_id(spark):
    """Shards take parts of an id that all rows share, equal rows too."""
    df = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("the same words again and again").alias("text"))
    path = scratch(spark, "ids-hot")
    shards = tokenids.write(df, tokenizer_path(), 2, path, shard_bytes=20_000).collect()
    assert sum(r.docs for r in shards) == 4000 and max(r.docs for r in shards) < 2000


def brute_clusters(rows, k, rounds, dims, by, seed):
    x = [(i, tuple(int(np.floor(by * float(np.float32(c)))) for c in v)) for i, v in rows if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cents = [v for _, v in sorted(x, key=key)[:k]]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    assign = lambda: [min((dist(v, c), j) for j, c in enumerate(cents)) for _, v in x]
    for _ in range(rounds):
        of = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(x, of) if c == j]
            if mine:
                cents[j] = tuple(sum(col) // len(mine) for col in zip(*mine))
    of = assign()
    sums = Counter()
    for d, j in of:
        sums[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return Counter((i, j, d, sums[j], sum(sums.values()), digest[j]) for (i, _), (d, j) in zip(x, of))


@pytest.mark.parametrize("n,k", [(600, 12), (5, 12)])
def test_clusters(spark, n, k):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 0.4, (n, 8)) + rng.integers(0, 4, (n, 1))
    if n > 100:
        base[50:300] = base[50]  # one very common vector
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(3, rows[4][1]), (3, rows[3][1]), (None, rows[2][1]), (None, None), (900, None), (901, [None] * 8), (902, [float("nan")] * 8), (903, [float("inf")] + [0.0] * 7), (904, []), (905, [1.0])]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<float>, cluster int, near string").repartition(5)
    got = centroids.clusters(df, k=k, rounds=3, dims=8, by=256, seed="2")
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, k, 3, 8, 256, "2")
    assert centroids.clusters(df.where("false"), dims=8).count() == 0
    assert got.columns == centroids.clusters(df.where("false"), dims=8).columns


def test_pivots_spare_exact_distances():
    """Bounds lose no nearest centroid and leave most distances out."""
    rng = np.random.default_rng(4)
    x = (rng.integers(-3, 4, (2000, 64)) * 400 + rng.integers(-20, 20, (2000, 64)))[rng.integers(0, 60, 2000)] + rng.integers(-9, 9, (2000, 64))
    cents = x[:40]
    pivots = centroids.far_apart(cents, 16)
    near = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2).astype(float))
    cluster, best, exact = centroids.nearest(x, near, cents, pivots)
    d = ((x[:, None] - cents[None]) ** 2).sum(2)
    assert (best == d.min(1)).all() and (cluster == d.argmin(1)).all() and exact < 0.5 * d.size


def test_clusters_refuse_what_a_long_cannot_hold(spark):
    df = spark.createDataFrame([(1, [1e7, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long"):
        centroids.clusters(df, dims=2).collect()


def brute_phrases(rows, least, longest, percent, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    dropped = {(lang, p[i : i + m]) for (lang, p), a in cands.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= percent * cands[lang, p[i : i + m]]}
    out = {}
    for (lang, p), a in cands.items():
        if (lang, p) not in dropped:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, ps in out.items() for k, (s, a, p, l, r) in enumerate(sorted(ps)[:top])}


@pytest.fixture(scope="module")
def talk():
    rng = np.random.default_rng(5)
    words = ["the", "of", "new", "york", "times", "Foo", "bar's", "é", "你好", "a-b", "x"] + [f"w{i}" for i in range(40)]
    p = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(300):
        w = rng.choice(words, int(rng.integers(1, 60)), p=p / p.sum()).tolist()
        if i % 3 == 0:
            w += ["new", "york", "times", "square", "garden", "show"]
        text = " ".join(x + ("" if rng.random() < 0.9 else rng.choice([".", ",", "\n", "\t", "\x0b", ";  "])) for x in w)
        rows.append((text, ["en", "fr", None][i % 3]))
    rows += [("", "en"), (None, "en"), (None, None), ("a " * 500 + "b", "de"), ("und one two " * 9, "und"), ("x\x1cy \x00 z\x85q " * 30, ""), ("same same other " * 15, "e\nn"), ("same same other " * 15, "e"), (" \t\n.,", "en")]
    return rows + rows[:40]


@pytest.mark.parametrize("sizes,percent,top", [({}, 100, 2000), ({"block": 97, "tile": 4, "side": 2}, 100, 2000), ({"block": 250, "tile": 4, "side": 0}, 60, 7)])
def test_phrases(spark, talk, sizes, percent, top):
    """With small tiles nearly all pairs, or all, are in sparse ones."""
    df = spark.createDataFrame([(i, *r, "k", 1) for i, r in enumerate(talk)], "doc_id int, text string, lang string, word string, n int").repartition(4)
    got = phrases.collocations(df, least=12, longest=5, percent=percent, top=top, sizes=phrases.Sizes(**sizes))
    assert {tuple(r) for r in got.collect()} == brute_phrases(talk, 12, 5, percent, top)


def test_phrases_of_long_texts_and_none(spark):
    text = ("Alpha beta gamma, delta " * 50 + "z" * 300 + " ") * 4
    df = spark.createDataFrame([(text, "en")] * 3, "text string, lang string")
    got = phrases.collocations(df, least=9, sizes=phrases.Sizes(segment=64, block=31))
    assert {tuple(r) for r in got.collect()} == brute_phrases([(text, "en")] * 3, 9, 5, 100, 2000)
    assert phrases.collocations(df.where("false")).count() == 0


def test_exact_scores(spark):
    """Products that pass 64 bits."""
    f = 3_000_000_000
    got = spark.createDataFrame([(f, 40 * f, [2 * f], [3 * f])], "a long, n long, pre array<long>, suf array<long>").selectExpr(
        "(cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0))) div (cast(pre[0] as decimal(19,0)) * cast(element_at(suf, -1) as decimal(18,0))) as s"
    )
    assert got.first().s == 1000 * f * 40 * f // (2 * f * 3 * f)


def test_numbered(spark):
    df = stored(spark.range(3000).select((F.col("id") * 7919 % 3001).alias("v"), F.lit("x").alias("_part")), "numbers")
    got = numbered(df, [F.col("v").desc()], "place").collect()
    assert [r.place for r in sorted(got, key=lambda r: -r.v)] == list(range(3000))
