"""Near duplicates: circulant MinHash, banding, exact confirmation.

1. Each text becomes its set of word shingles, as 64-bit hashes, and from it
   one signature: a first permutation scatters the hashes, a second one,
   circularly shifted by one place per coordinate, gives all coordinates
   (the lowest value each).
2. Texts of one set are one class with its smallest id.  Classes that share a
   band of the signature are candidates.  Each bucket first compares its
   members with its smallest one only; links are confirmed on full sets.
3. Where members of a bucket are then still in several components, texts that
   candidates connect are a group, and what its texts differ in is joined, not
   what they share: with a centre C (the shingles that more than half of the
   group has) and D(a) = a XOR C, |a XOR b| = |D(a)| + |D(b)| - 2 |D(a) AND D(b)|,
   and a link means |a XOR b| <= (n + m) / 7.  So a linked pair shares
   t = (|D(a)| + |D(b)| - (n + m) / 7) / 2 elements of D, hence one among the
   first |D| - t + 1 of each in any one order, here rare ones first.  What a text
   has of its own fills its prefix exactly when it is too far from the centre,
   so near copies of one template meet nobody.  Pairs with t <= 0 are linked;
   the text of least |D| - n / 7 is linked with both of them, and meets them all.
4. Components are the result of merging along all links.

No step emits the pairs of a group: copies are folded before, near copies
meet their bucket's smallest member, and a component isn't joined with itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cirrus.llm.common import bounded_batches, give_back, passing_tables, stored

WORDS = 5
#: Links have 100 * common shingles >= PERCENT * shingles of either.
PERCENT = 75
#: A pair at the least similarity shares no band with a probability of
#: (1 - 0.75**5)**40 = 2e-5.
BANDS, ROWS = 40, 5
#: Texts that one group compares with a text at a time.
FANOUT = 64

_SIGNED = "id long, n_shingles long, set_hash binary, bands array<long>"


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, n_shingles, component_id, kept).

    Words are lower-cased (A-Z) runs free of ASCII white space; a text of
    fewer than WORDS words is one shingle; one without words, or null, is
    empty and linked with nothing.  ``component_id`` is the smallest id that
    links reach, ``kept`` whether it is the row's own.  Rows that share an id
    are one document, with all their texts.  Rows without id are kept, with a
    null component, and linked with nothing.  Very long texts are compared
    whole; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    with passing_tables() as keep:
        signed = keep(stored(rows.mapInArrow(_signed, _SIGNED), "signed"))
        has = signed.where("id IS NOT NULL AND set_hash IS NOT NULL")
        classes = stored(has.groupBy("set_hash").agg(F.min("id").alias("rep"), F.max("id").alias("last")), "classes")
        member = has.select("id", "set_hash").join(classes.select(F.col("set_hash").alias("_h"), "rep"), F.col("set_hash") == F.col("_h")).select("id", "rep").distinct()
        member = stored(member, "members")
        copies = member.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

        firsts = has.join(classes.select(F.col("set_hash").alias("_h"), "rep"), (F.col("set_hash") == F.col("_h")) & (F.col("id") == F.col("rep")))
        firsts = firsts.select("id", "bands").dropDuplicates(["id", "bands"])
        keyed = firsts.select("id", F.posexplode("bands").alias("band", "key")).distinct()
        keyed = stored(keyed, "keyed")
        lows = keyed.groupBy(F.col("band").alias("_b"), F.col("key").alias("_k")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        buckets = stored(keyed.join(lows, (F.col("band") == F.col("_b")) & (F.col("key") == F.col("_k"))).select("id", "band", "key", "first"), "buckets")
        star = stored(buckets.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct(), "candidates")
        texts = rows.join(buckets.select(F.col("id").alias("_i")).distinct(), F.col("id") == F.col("_i"), "left_semi")
        texts = stored(texts, "texts")
        links = stored(confirmed(star, texts), "links")
        roots = merged(links)

        # several components in a bucket, its first member aside: its pairs are tried
        left = buckets.where("id <> first").select("id", "band", "key").join(roots.select(F.col("id").alias("_i"), "root"), F.col("id") == F.col("_i"), "left")
        left = stored(left.select("id", "band", "key", F.coalesce("root", "id").alias("root")), "left")
        mixed = left.groupBy(F.col("band").alias("_b"), F.col("key").alias("_k")).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        mixed = left.join(stored(mixed.select("_b", "_k"), "mixed"), (F.col("band") == F.col("_b")) & (F.col("key") == F.col("_k"))).select("id", "root").distinct()
        mixed = stored(mixed, "unsettled")
        if not mixed.isEmpty():
            groups = merged(star)
            mixed = mixed.join(groups.select(F.col("id").alias("_i"), F.col("root").alias("group")), F.col("id") == F.col("_i")).select("id", "root", "group")
            links = stored(links.unionByName(confirmed(across(stored(mixed, "grouped"), texts), texts)), "all-links")
        roots = keep(merged(stored(links.unionByName(copies), "links-and-copies")))
    out = signed.select("id", "n_shingles").join(roots.select(F.col("id").alias("_i"), "root"), F.col("id") == F.col("_i"), "left")
    component = F.coalesce("root", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`components` keeps; of rows that share
    an id the least, by all columns."""
    kept = components(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_kept")).distinct()
    twice = stored(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_twice")).count().where("count > 1").drop("count"), "twice")
    out = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col("_kept")), "left_semi")
    if twice.isEmpty():
        return out
    once = out.join(twice, F.col(id_col) == F.col("_twice"), "left_anti")
    order = Window.partitionBy(id_col).orderBy(*[F.col(c) for c in docs.columns])
    least = out.join(twice, F.col(id_col) == F.col("_twice"), "left_semi").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return once.unionByName(least)


_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh64_intdigest(word)
        if len(self) < 200_000 and len(word) <= 64:
            self[word] = out
        return out


_WORD_HASHES = _WordHash()


def shingles(text: str) -> np.ndarray:
    """The sorted distinct shingles of a text, as 64-bit hashes."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space
    if len(_WORD_HASHES) >= 200_000:
        _WORD_HASHES.clear()
    h = np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(h))
    if not n:
        return h
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out = _mixed64((out + _MIX[0]) ^ h[k : len(h) - n + 1 + k])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """Circulant MinHash of a non-empty set: BANDS * ROWS coordinates."""
    first = (_mixed64(found ^ _MIX[0]) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(BANDS * ROWS, dtype=np.uint32)
    low = np.full(len(shifts), np.uint32(0xFFFFFFFF))
    for a in range(0, len(first), 256):
        x = first[a : a + 256, None] + shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        np.minimum(low, x.min(0), out=low)
    return low


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, hashes, bands = [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text or "")
            counts.append(len(found))
            if len(found):
                low = signature(found)
                keys = np.zeros(BANDS, np.uint64)
                for k in range(ROWS):
                    keys = _mixed64(keys + _MIX[0] ^ low[k::ROWS].astype(np.uint64))
                hashes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                bands.append(keys.view(np.int64))
            else:
                hashes.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["id", "n_shingles", "set_hash", "bands"],
        )
    give_back()


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) those that are linked by their full sets; ``texts``
    (id, text; a stored table) has all of them.

    A text that many are compared with goes along with FANOUT of them at a
    time, so that neither a task nor the shuffle holds it once a pair.
    """
    pairs = stored(pairs, "pairs")
    sizes = stored(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(FANOUT)).cast("int").alias("salts")), "pair-sizes")
    salted = pairs.join(sizes.withColumnRenamed("b", "_b"), F.col("b") == F.col("_b")).select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"))
    many = salted.join(texts, F.col("a") == F.col("id")).select("a", "b", "salt", "text")
    one = sizes.join(texts, F.col("b") == F.col("id")).select(F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("part"), F.col("text").alias("whole"))

    def compare(ones: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(t or "") for t in ones["whole"]]
        out = [(a, b) for a, b, t in zip(others["a"], others["b"], others["text"]) if any(linked(shingles(t or ""), s) for s in sets)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    found = one.groupBy("hub", "part").cogroup(many.groupBy("b", "salt")).applyInPandas(lambda x, y: compare(x, y), "a long, b long")
    return found.distinct()


def linked(one: np.ndarray, other: np.ndarray) -> bool:
    low, high = sorted((len(one), len(other)))
    if 100 * low < PERCENT * high or not low:
        return False
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= PERCENT * (low + high - common)


def across(mixed: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``mixed`` (id, root, group) of one group and different
    components: all linked ones are among them, or each of the two is in a
    pair with a third.  See the module's text, 3.

    An element of D that one text only has is counted, not joined.  Of each
    element, the component that has most of its texts is met by the others,
    not by itself.
    """
    sets = texts.join(mixed.select(F.col("id").alias("_i"), "root", "group"), F.col("id") == F.col("_i")).select("group", "id", "root", "text")
    sets = stored(sets.mapInArrow(_sets, "group long, id long, root long, uid long, n long, s array<long>").dropDuplicates(["group", "uid"]), "sets")
    sizes = sets.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    often = sets.select("group", F.explode("s").alias("s")).groupBy("group", "s").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    often = often.join(sizes.select(F.col("group").alias("_g"), "size"), F.col("group") == F.col("_g")).where(2 * F.col("times") > F.col("size"))
    # a centre is no longer than twice the longest text
    centres = sizes.select(F.col("group").alias("_g"), "size").join(often.groupBy(F.col("group").alias("_c")).agg(F.collect_list("s").alias("centre")), F.col("_g") == F.col("_c"), "left")
    salts = F.ceil(F.col("size") / F.lit(FANOUT)).cast("int")
    centres = stored(centres.select(F.col("_g").alias("hub"), salts.alias("salts"), F.coalesce("centre", F.array().cast("array<long>")).alias("centre")), "centres")
    ones = centres.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("part"), "centre")
    many = sets.join(centres.select(F.col("hub").alias("_h"), "salts"), F.col("group") == F.col("_h")).withColumn("salt", F.pmod(F.xxhash64("uid"), F.col("salts")).cast("int"))
    many = many.select("group", "salt", "id", "root", "uid", "n", "s")
    differing = ones.groupBy("hub", "part").cogroup(many.groupBy("group", "salt")).applyInArrow(_differing, "group long, id long, root long, uid long, n long, d array<long>")
    differing = stored(differing.withColumn("size", F.size("d").cast("long")).withColumn("value", 7 * F.size("d").cast("long") - F.col("n")), "differing")
    # the text that is nearest to the centre, by value = 7 |D| - n, meets all that are linked with it unseen
    nearest = differing.groupBy("group").agg(F.min(F.struct("value", "id")).alias("m")).select(F.col("group").alias("_g"), F.col("m.value").alias("least"), F.col("m.id").alias("hub"))
    nearest = stored(nearest, "nearest")
    placed = differing.join(nearest, F.col("group") == F.col("_g")).drop("_g")
    unseen = placed.where((F.col("value") <= -F.col("least")) & (F.col("id") != F.col("hub"))).select(F.col("id").alias("a"), F.col("hub").alias("b"))
    # with any other text a pair has to share so many elements at least
    need = F.greatest(F.lit(1), F.ceil((F.col("value") + F.col("least")) / F.lit(14)).cast("long"))
    each = placed.select("group", "id", "root", "uid", "n", "size", "value", need.alias("need"), F.explode("d").alias("e"))
    shared = stored(each.groupBy("group", "e").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "shared")
    found = each.join(shared.select(F.col("group").alias("_g"), F.col("e").alias("_e"), "texts"), (F.col("group") == F.col("_g")) & (F.col("e") == F.col("_e"))).drop("_g", "_e")
    of_set = Window.partitionBy("group", "uid")
    ranked = found.withColumn("own", F.col("size") - F.count(F.lit(1)).over(of_set)).withColumn("place", F.row_number().over(of_set.orderBy("texts", "e")) + F.col("own"))
    able = (F.col("place") <= F.col("size") - F.col("need") + 1) & (F.col("need") <= F.col("size") - F.col("own"))
    prefix = stored(ranked.where(able).select("group", "e", "id", "root", "n", "size", "value", "own", "place"), "prefix")
    by_root = prefix.groupBy("group", "e", "root").agg(F.count(F.lit(1)).alias("texts"))
    tops = by_root.groupBy(F.col("group").alias("_g"), F.col("e").alias("_e")).agg(F.max_by("root", F.struct("texts", "root")).alias("top"), F.count(F.lit(1)).alias("roots")).where("roots > 1").drop("roots")
    met = stored(prefix.join(stored(tops, "tops"), (F.col("group") == F.col("_g")) & (F.col("e") == F.col("_e"))).drop("_g", "_e"), "met")
    others = met.where("root <> top").select(*[F.col(c).alias(f"_{c}") for c in ("group", "e", "id", "root", "n", "size", "value", "own", "place")])
    t = F.ceil((F.col("value") + F.col("_value")) / F.lit(14)).cast("long")
    fits = lambda c: F.col(f"{c}place") <= F.col(f"{c}size") - t + 1
    behind = F.least(F.col("size") - F.col("place"), F.col("_size") - F.col("_place"))
    before = F.least(F.col("place") - F.col("own"), F.col("_place") - F.col("_own"))
    once = (F.col("root") == F.col("top")) | (F.col("id") < F.col("_id"))
    same = (F.col("group") == F.col("_group")) & (F.col("e") == F.col("_e"))
    both = met.join(others, same & once & (F.col("root") != F.col("_root")) & (t > 0) & fits("") & fits("_") & (before + behind >= t))
    return both.select(F.greatest("id", "_id").alias("a"), F.least("id", "_id").alias("b")).unionByName(unseen).distinct()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t or "") for t in batch.column(3).to_pylist()]
        uids = [xxhash.xxh64_intdigest(f.tobytes(), seed=i & 0xFFFFFFFF) for f, i in zip(found, batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in range(3)), pa.array(np.array(uids, np.uint64).view(np.int64)), pa.array([len(f) for f in found], pa.int64()), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))],
            names=["group", "id", "root", "uid", "n", "s"],
        )
    give_back()


def _differing(centre: pa.Table, sets: pa.Table) -> pa.Table:
    """What each set and the centre don't share; a shingle that the centre
    has and the set lacks is the same element for all sets, and can't be one
    that a set has and the centre lacks."""
    c = np.sort(np.asarray(centre.column("centre")[0].values)) if centre.num_rows else np.zeros(0, np.int64)
    differ = [np.setxor1d(np.asarray(s.values), c, assume_unique=True) for s in sets.column("s")]
    return pa.table({**{k: sets.column(k) for k in ("group", "id", "root", "uid", "n")}, "d": pa.array(differ, pa.list_(pa.int64()))})


#: Hooks that are followed in a round of :func:`merged`: 2 to this power.
FOLLOWED = 3
#: Links that a task takes alone: a round of no more has no shuffle.
FEW_LINKS = 1 << 16


def merged(links: DataFrame) -> DataFrame:
    """(id, root) of every id in ``links`` (a, b): the smallest id reachable.

    Each round hooks every node on the neighbour (or itself) with the least
    number that the round's hash gives, follows hooks to hooks, and contracts
    the links accordingly, until none is left.  As numbers are drawn anew, a
    chain shrinks by a factor a round, however its ids rise or fall; a hub is
    never gathered, only its least neighbour is taken.  Rounds of FEW_LINKS
    links or fewer, mostly the last ones, run in one task, as their shuffles
    would be many times their work."""
    with passing_tables() as keep:
        edges = stored(links.where("a <> b").select("a", "b").distinct(), "edges")
        roots, turn = None, 0
        while left := edges.count():
            dealt = (lambda df: df.coalesce(1)) if left <= FEW_LINKS else (lambda df: df)
            drawn = lambda c, salt=turn: F.struct(F.xxhash64(c, F.lit(salt)).alias("h"), F.col(c).alias("id"))
            both = dealt(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
            least = both.groupBy(F.col("a").alias("node")).agg(F.min(drawn("b")).alias("m"))
            hooks = dealt(stored(least.select("node", F.least(F.col("m"), drawn("node"))["id"].alias("low")), "hooks"))
            for _ in range(FOLLOWED):
                next_ = hooks.select(F.col("node").alias("_n"), F.col("low").alias("_low"))
                hooks = dealt(hooks.join(next_, F.col("low") == F.col("_n")).select("node", F.col("_low").alias("low")))
            hooks = stored(hooks, "followed")
            if roots is None:
                roots = hooks.select(F.col("node").alias("id"), F.col("low").alias("root"))
            else:
                roots = roots.join(hooks, F.col("root") == F.col("node"), "left").select("id", F.coalesce("low", "root").alias("root"))
            roots = stored(roots, "roots")
            one = dealt(dealt(edges).join(dealt(hooks), F.col("a") == F.col("node")).select(F.col("low").alias("x"), "b"))
            two = dealt(one.join(dealt(hooks), F.col("b") == F.col("node")).select("x", F.col("low").alias("y")))
            edges = stored(two.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
            turn += 1
        if roots is None:
            return links.sparkSession.createDataFrame([], "id long, root long")
        lowest = roots.groupBy(F.col("root").alias("_r")).agg(F.min("id").alias("low"))
        return keep(stored(roots.join(lowest, F.col("root") == F.col("_r")).select("id", F.col("low").alias("root")), "components"))
