"""Extendible hashing into shards with a byte limit.

A directory is indexed by the leading bits of a row's hash.  It starts from
one shard; only shards over the limit are split, on one more bit, until each
fits.  The bytes of all prefixes of a row's cell (the finest prefix of a
round) are summed in one aggregation, so a round settles several bits; only
the rows of cells that are still too large go on to the next round.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import running_sum, stored

#: Bits of the hash: the 15 leading hex digits of an MD5 digest.
BITS = 60
#: Bits that a round goes beyond what evenly spread bytes would need.
SLACK_BITS = 4


def row_hash(id_col: Column, text: Column) -> Column:
    """BITS bits of a row's id and text, as a long.  Only rows that are equal
    in both meet."""
    key = F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, depth, shard, page) of every row of ``docs``.

    ``shard``: the leading ``depth`` bits as a string of 0 and 1, "" where
    all fits one shard.  No (shard, page) holds over ``limit`` bytes, but for
    a single row that does by itself.  Rows with the same hash (equal id and
    text) can't be split by bits: where they exceed the limit together, the
    shard has further pages.  Null texts have 0 bytes; other columns are
    ignored.  An empty table gives no rows.
    """
    h = row_hash(F.col(id_col), F.col(text_col)).alias("h")
    n_bytes = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")
    rows = stored(docs.select(F.col(id_col).cast("long").alias("id"), h, n_bytes), "shards")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    done, depth = [], 0
    step = max(1, math.ceil(math.log2(max(1, total / limit)))) + SLACK_BITS
    while True:
        upto = min(BITS, depth + step)
        cells, still = _round(rows, depth, upto, limit)
        cell = _prefix(F.col("h"), upto)
        settled = rows.withColumn("cell", cell).join(cells, "cell")
        done.append(settled.select("id", "h", "n_bytes", "depth"))
        if not still:
            break
        # only rows in cells that are still too large go on
        rows = stored(rows.withColumn("cell", cell).join(cells, "cell", "left_anti").drop("cell"), "shards-on")
        depth, step = upto, SLACK_BITS * 2
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.substring(F.lpad(F.bin("h"), BITS, "0"), F.lit(1), F.col("depth")))
    return _paged(out.withColumn("shard", bits), limit).select(F.col("id").alias(id_col), "n_bytes", "depth", "shard", "page")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, BITS - bits)


def _round(rows: DataFrame, least: int, upto: int, limit: int) -> tuple[DataFrame, bool]:
    """The directory of the cells (prefixes of ``upto`` bits) that are settled
    at a depth from ``least`` to ``upto``: (cell, depth); and whether others
    are left.  A cell of rows with one hash is settled at ``upto``: bits can't
    split it."""
    sums = [F.sum("n_bytes").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")]
    cells = stored(rows.groupBy(_prefix(F.col("h"), upto).alias("cell")).agg(*sums), "cells")
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(least), F.lit(upto))))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {upto} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    fits = fits.where((F.col("n") <= limit) | (F.col("low") == F.col("high"))).select("depth", "prefix")
    directory = stored(levels.join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth")), "directory")
    return directory, upto < BITS and directory.count() < cells.count()


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Pages of the shards that rows of one hash overfill: they take pages in
    turn, each as many as fit."""
    rows = stored(rows, "sharded")
    alike = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.max("n_bytes").alias("b")).where(F.col("c") * F.col("b") > limit).where("c > 1")
    alike = stored(alike.select("h", F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.col("b"))).alias("a_page")), "pages")
    if alike.isEmpty():
        return rows.withColumn("page", F.lit(0).cast("long"))
    hot = rows.join(alike, "h")
    hot = stored(hot.select("*", F.lit(1).cast("long").alias("one"), F.rand(7).alias("spread")), "paged")
    ranked = running_sum(hot, ["h"], [F.col("spread")], "one", "rank")
    ranked = ranked.withColumn("page", F.floor(F.col("rank") / F.col("a_page")))
    rest = rows.join(alike, "h", "left_anti").withColumn("page", F.lit(0).cast("long"))
    return rest.unionByName(ranked.select(rest.columns))
