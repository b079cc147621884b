"""Document quality: rule statistics, and an isolation forest over them.

The forest is grown on a bounded sample of labelled rows, whose good ones say
which levels of a statistic are usual; its verdict's threshold is set from the
scores of all labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import bounded_batches, stored

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_next_equal", "n_upper")
_STATS = "id long, " + ", ".join(f"{c} long" for c in (*BASE, *MORE))

#: Labelled rows that the forest is grown on, at most (lowest hashes of ids).
FIT_ROWS = 8192
TREES, TREE_ROWS = 100, 256
#: Share of the well-labelled rows that the forest's verdict may reject.
GOOD_LOSS = 0.003
SCORE_STEPS = 4000


def assess(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the rule statistics, base_failed, the forest's
    score (0 to 1, higher: easier to isolate) and kept.

    ``labels``: (doc_id, quality), 1 for good; where a doc_id has several
    labels the lowest counts, null ones don't.  Without labels of both kinds
    the forest rejects nothing.  Null texts are empty (and fail for want of
    words); null ids and repeated rows are assessed like any other, very long
    texts whole; other columns are ignored.  An empty table gives no rows.
    """
    stats, forest, reject_from = fitted(docs, labels, id_col, text_col)
    scored = stats.mapInArrow(_scores(forest), _STATS + ", score double") if forest else stats.withColumn("score", F.lit(0.0))
    fine = F.lit(True) if reject_from is None else F.col("score") < reject_from
    out = scored.withColumn("base_failed", failed())
    return out.select(F.col("id").alias(id_col), *BASE, "base_failed", (~F.col("base_failed") & fine).alias("kept"), "score")


def passing(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`assess` keeps, all columns as they are."""
    _, forest, reject_from = fitted(docs, labels, id_col, text_col)

    @F.pandas_udf("boolean")
    def fine(texts: pd.Series) -> pd.Series:
        found = np.array([statistics(t or "") for t in texts], np.int64).reshape(-1, len(BASE) + len(MORE))
        rows = dict(zip((*BASE, *MORE), found.T))
        ok = ~((rows["n_words"] < 10) | (100 * rows["n_repeat_words"] > 20 * rows["n_words"]))
        if reject_from is not None:
            ok &= forest.score(features(rows)) < reject_from
        return pd.Series(ok)

    return docs.where(fine(F.col(text_col)))


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Forest | None, float | None]:
    """The statistics of all documents, the forest, and the score from which
    on it rejects (None: nothing)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    stats = stored(rows.mapInArrow(_statistics, _STATS), "quality")
    told = labels.select(F.col("doc_id").cast("long").alias("known"), F.col("quality").cast("int").alias("quality"))
    told = told.where("known IS NOT NULL AND quality IS NOT NULL").groupBy("known").agg(F.min("quality").alias("quality"))
    known = stored(stats.join(told, F.col("id") == F.col("known")).drop("known"), "quality-known")
    sample = known.orderBy(F.xxhash64("id"), *stats.columns).limit(FIT_ROWS).toPandas()
    if not len(sample):
        return stats, None, None
    x = features(sample)
    forest = Forest.grown(x, len(sample), usual_levels(x[(sample["quality"] == 1).to_numpy()]))
    tried = known.where(~failed()).mapInArrow(_scores(forest), _STATS + ", quality int, score double")
    step = F.floor(F.col("score") * SCORE_STEPS).cast("int").alias("step")
    counts = tried.groupBy(step).agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") == 0).cast("long")).alias("bad")).collect()
    return stats, forest, threshold({r["step"]: (r["good"], r["bad"]) for r in counts})


def failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def threshold(counts: dict[int, tuple[int, int]]) -> float | None:
    """The score from which on documents are rejected: the lowest with at most
    GOOD_LOSS of the good rows and at least as many bad ones above it."""
    good_total, best, good, bad = sum(g for g, _ in counts.values()), None, 0, 0
    for step in sorted(counts, reverse=True):
        good, bad = good + counts[step][0], bad + counts[step][1]
        if good > GOOD_LOSS * good_total:
            break
        if counts[step][1] and bad >= good:
            best = step / SCORE_STEPS
    return best


def statistics(text: str) -> tuple[int, ...]:
    """BASE and MORE of one text."""
    raw = text.encode()
    letters = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    points = len(raw) - int(letters[0x80:0xC0].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    n_repeat = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered_to = 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                n_repeat += i + 5 - max(i, covered_to)
                covered_to = i + 5
    return (
        len(words),
        points - int(letters[9:14].sum() + letters[32]),
        int(letters[[ord(c) for c in SYMBOLS]].sum()),
        len(lines) - len(set(lines)),
        n_repeat,
        sum(map(eq, words, words[1:])),
        int(letters[65:91].sum()),
    )


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", *BASE, *MORE]
    for batch in batches:
        found = np.array([statistics(t or "") for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(names) - 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in found.T)], names=names)


def features(rows) -> np.ndarray:
    """What the forest splits on: all rule statistics as rates, so that length
    alone isolates nothing, and the mean word length, long or short."""
    col = {c: np.asarray(rows[c], float) for c in (*BASE, *MORE)}
    words, chars = np.maximum(col["n_words"], 1), np.maximum(col["word_chars"], 1)
    per_word = [col[c] / words for c in ("n_symbols", "n_dup_lines", "n_repeat_words", "n_next_equal")]
    return np.stack([*per_word, col["n_upper"] / chars, chars / words, -chars / words], axis=1)


def usual_levels(good: np.ndarray) -> np.ndarray:
    """Up to which level each feature says nothing: that of all good rows but
    GOOD_LOSS, shared out among the features.  Without good rows each counts."""
    if not len(good):
        return np.full(good.shape[1], -np.inf)
    return np.quantile(good, 1 - GOOD_LOSS / good.shape[1], axis=0, method="higher")


class Forest:
    """Isolation trees as arrays: feature (-1: leaf), split, children, and for
    leaves the expected path length, depth included."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], usual: float, levels: np.ndarray):
        self.trees, self.usual, self.levels = trees, usual, levels

    @classmethod
    def grown(cls, x: np.ndarray, seed: int, levels: np.ndarray | None = None) -> Forest:
        """``levels``: what lower values of a feature count as."""
        rng = np.random.default_rng(seed)
        levels = np.full(x.shape[1], -np.inf) if levels is None else levels
        x = np.maximum(x, levels)
        n = min(TREE_ROWS, len(x))
        deepest = max(1, int(np.ceil(np.log2(max(n, 2)))))
        return cls([_tree(x[rng.choice(len(x), n, replace=False)], deepest, rng) for _ in range(TREES)], max(_expected(n), 1e-9), levels)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / usual path length)."""
        x, total = np.maximum(x, self.levels), np.zeros(len(x))
        for feature, split, left, right, path in self.trees:
            at = np.zeros(len(x), np.int32)
            while True:
                f = feature[at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                i = at[inner]
                at[inner] = np.where(x[inner, f[inner]] < split[i], left[i], right[i])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / self.usual)


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def _tree(x: np.ndarray, deepest: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, depth + _expected(len(rows))])
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(0), np.zeros(0))
        able = np.flatnonzero(low < high)
        if depth < deepest and len(rows) > 1 and len(able):
            f = int(rng.choice(able))
            split = float(rng.uniform(low[f], high[f]))
            under = rows[:, f] < split
            if under.any() and not under.all():
                nodes[me][:2] = f, split
                nodes[me][2] = grow(rows[under], depth + 1)
                nodes[me][3] = grow(rows[~under], depth + 1)
        return me

    grow(x, 0)
    cols = list(zip(*nodes))
    return np.array(cols[0], np.int32), np.array(cols[1]), np.array(cols[2], np.int32), np.array(cols[3], np.int32), np.array(cols[4])


def _scores(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(i + 1).to_numpy(zero_copy_only=False) for i, c in enumerate((*BASE, *MORE))}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(features(rows)))], names=[*batch.schema.names, "score"])

    return run
