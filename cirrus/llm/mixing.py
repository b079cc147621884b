"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, served twice at
most.  A document's virtual finish time is its source's words up to and with
it over the source's target; sorting all by finish time interleaves the
sources in proportion to their targets.  The queue is cut where its words
reach the budget: what has finished is taken whole, and of the document that
each source is serving at that moment, the words served so far (the packets
of the queue are words).  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import running_sum, stored, word_count

WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, and times a document may come.
SHARE, REPEATS = 1.5, 2


def sized(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str, shuffle_col: str) -> DataFrame:
    """(doc_id, source, size, spread): ``spread`` gives the shuffled order."""
    size = word_count(F.col(text_col)).alias("size")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size, F.col(shuffle_col).alias("_by"))
    return rows.withColumn("spread", shuffled(seed, "_by", "size")).drop("_by")


def shuffled(seed: str, *columns: str) -> Column:
    """A uniform double in [0, 1) that only depends on the row and the seed."""
    key = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) of every source.

    Sources in code point order, null last, weigh ``weights``, repeating.
    The budget, ``share`` of all words, is dealt by weight; a target stops at
    ``repeats`` times its source's size, and the excess goes to the others by
    weight until none is above: with sources in order of size over weight,
    those that stop are the first ones, and the rate of the others follows
    from what these leave.  ``sizes``: (source, source_size), stored.
    """
    order = [F.col("source").asc_nulls_last()]
    place = running_sum(sizes.withColumn("_one", F.lit(1).cast("long")), [], order, "_one", "_place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int")).cast("long")
    ranked = place.select("source", "source_size", weight.alias("weight"))
    ranked = ranked.withColumn("most", F.col("source_size") * repeats).withColumn("stop", F.col("most") / F.col("weight"))
    ranked = stored(ranked, "sources")
    total = ranked.agg(F.sum("source_size"), F.sum("weight"), F.max("stop")).first()
    if not total[0]:
        return ranked.select("source", "source_size", F.lit(0.0).alias("target"))
    stops = [F.col("stop"), F.col("source").asc_nulls_last()]
    by_stop = stored(running_sum(ranked, [], stops, "most", "_stopped"), "stops")
    by_stop = running_sum(by_stop, [], stops, "weight", "_weights")
    rate = (F.lit(share * total[0]) - F.col("_stopped")) / (F.lit(total[1]) - F.col("_weights"))
    # the first source that doesn't stop gives the rate of all that follow
    first = by_stop.where(F.col("stop") >= rate).agg(F.min(F.struct("stop", "weight", rate.alias("rate"))).alias("m")).first()["m"]
    rate = first["rate"] if first else total[2]
    return ranked.select("source", "source_size", F.least(F.lit(float(rate)) * F.col("weight"), F.col("most").cast("double")).alias("target"))


def queue(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shuffle_col: str | None = None) -> DataFrame:
    """The mix in serving order: every copy of which a word is taken, with
    (doc_id, source, copy, start, finish, taken, mix_start), the last the
    words of the mix before it.  ``shuffle_col`` (else the id) seeds the
    order."""
    served = _served(docs, seed, id_col, text_col, source_col, shuffle_col or id_col).where("taken > 0")
    out = served.select(F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "size", "copy", "start", "finish", "taken", "mix_start")
    return out.orderBy("mix_start")  # a range sort of all copies


def mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: (id, size, source_size, target, taken, mix_start).

    ``target`` is its source's, ``taken`` the words that the mix takes of all
    its copies, ``mix_start`` the words of the mix before its first copy.  A
    source's taken words are its target, rounded down.  Null texts have size
    0; null sources are one source, the last; repeated rows are documents of
    their own; null ids are allowed and other columns ignored.  An empty table
    gives no rows.  The same rows give the same mix in any order.
    """
    first = _served(docs, seed, id_col, text_col, source_col, id_col).where("copy = 0")
    return first.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", F.col("taken_all").alias("taken"), "mix_start")


def mixed_texts(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as rows of ``docs``: one for every copy, with all columns; of a
    copy that isn't taken whole, the words taken, joined by spaces."""
    rows = stored(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-rows")
    order = queue(rows, seed, "_mix_row", text_col, source_col, shuffle_col=id_col)
    order = order.select(F.col("_mix_row").alias("_mix_at"), F.col("size").alias("_mix_size"), F.col("taken").alias("_mix_taken"))
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    part = F.when(F.col("_mix_taken") < F.col("_mix_size"), F.array_join(F.slice(words, F.lit(1), F.col("_mix_taken").cast("int")), " ")).otherwise(F.col(text_col))
    return rows.join(order, F.col("_mix_row") == F.col("_mix_at")).withColumn(text_col, part).select(*docs.columns)


def _served(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str, shuffle_col: str) -> DataFrame:
    """Every copy with its virtual times, the words taken of it and of all
    copies of its document, and its place in the mix."""
    rows = stored(sized(docs, seed, id_col, text_col, source_col, shuffle_col), "sizes")
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    told = stored(targets(sizes), "targets").select(F.col("source").alias("_source"), "source_size", "target")
    order = [F.col("spread"), F.col("doc_id").asc_nulls_last(), F.col("size")]
    rows = running_sum(rows, ["source"], order, "size", "before")
    rows = rows.join(told, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # queues are served at the rate of their targets, so that all reach the
    # budget at time 1; a word's finish time is its place over the target
    budget, per = F.floor("target").cast("long"), F.when(F.col("target") > 0, F.col("target"))
    taken = lambda copy: F.greatest(F.lit(0).cast("long"), F.least("size", budget - F.col("before") - copy * F.col("source_size")))
    rows = rows.withColumn("taken_all", sum((taken(F.lit(k)) for k in range(1, REPEATS)), taken(F.lit(0))))
    copies = rows.withColumn("copy", F.explode(F.array(*[F.lit(k) for k in range(REPEATS)]))).withColumn("taken", taken(F.col("copy")))
    begin = F.col("before") + F.col("copy") * F.col("source_size")
    copies = copies.withColumn("start", F.coalesce(begin / per, F.lit(0.0))).withColumn("finish", F.coalesce((begin + F.col("size")) / per, F.lit(0.0)))
    # sorted by finish time; copies beyond the budget, of which nothing is
    # taken, come last by their hash
    copies = stored(copies, "copies")
    late = F.col("start") >= 1
    key = F.when(late, 2 + F.col("spread")).otherwise(F.least("finish", F.lit(1.999)))
    copies = copies.withColumn("_key", key)
    ahead = [F.col("_key"), F.col("finish"), F.col("spread"), F.col("doc_id").asc_nulls_last(), F.col("copy"), F.col("source").asc_nulls_last()]
    return running_sum(copies, [], ahead, "taken", "mix_start")
