"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input is an embedding of the word and the mean embedding of its
character sequences, so that unseen forms of a word still say something.
Every text is covered by overlapping windows of words; each is scored by the
network, and a text by its highest window.  Trained in numpy on a bounded
sample of labelled rows; the score is calibrated over all other labelled rows
that may be learnt from.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import bounded_batches, stored

#: Words of a window, and words by which windows advance.
WINDOW, ADVANCE = 48, 32
#: Labelled rows that the network is trained on, at most, by label; and the
#: most windows taken of them.
FIT_DOCS = {1: 1500, 0: 3000}
FIT_WINDOWS = {1: 12_000, 0: 16_000}
#: The score from which on a text is predicted toxic.
TOXIC_FROM = 0.7
STEPS_A_UNIT = 16

WORDS, GRAMS, DIM, HIDDEN, ATTENTION = 1 << 13, 1 << 14, 8, 8, 8
#: Characters of a word's start that have an embedding of their own.
START = 4
#: Texts that a word or sequence is in before its odds count.
SEEN_IN = 4
#: Share of the words' inputs that training leaves out at a time.
DROPPED = 0.3
_MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_"


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, held_out, score, predicted, n_windows).

    ``labels``: (doc_id, toxic).  Rows whose crc32(id as text) mod 3 is 1 are
    held out: nothing is learnt from their labels.  Of several labels of an
    id the highest counts.  Only texts are inputs of the score.  Null and
    empty texts score 0; null ids aren't held out; repeated rows are scored
    alike, very long ones whole; other columns are ignored.  Without learnable
    labels of both kinds every score is 0; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    fold = lambda c: F.crc32(F.col(c).cast("string")) % 3
    told = labels.select(F.col("doc_id").cast("long").alias("known"), F.col("toxic").cast("int").alias("toxic"))
    told = told.where("known IS NOT NULL AND toxic IS NOT NULL").where(fold("known") != 1).groupBy("known").agg(F.max("toxic").alias("toxic"))
    told = stored(told, "toxic-labels")
    net, tried_on = fitted(rows, told)
    held_out = F.coalesce(fold("id") == 1, F.lit(False)).alias("held_out")
    if net is None:
        zero = F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("n_windows")
        return rows.select(F.col("id").alias(id_col), held_out, *zero)
    scored = stored(rows.mapInArrow(_logits(net), "id long, logit double, n_windows long"), "toxic-logits")
    step = F.floor(F.col("logit") * STEPS_A_UNIT).cast("int").alias("step")
    tried = scored.where("n_windows > 0").join(tried_on, scored["id"] == tried_on["known"]).groupBy(step)
    counts = tried.agg(F.sum((F.col("toxic") == 1).cast("long")).alias("toxic"), F.sum((F.col("toxic") == 0).cast("long")).alias("clean")).collect()
    from_logit = cut({r["step"]: (r["toxic"], r["clean"]) for r in counts})
    shift = math.log(TOXIC_FROM / (1 - TOXIC_FROM)) - from_logit
    value = F.when(F.col("n_windows") > 0, 1 / (1 + F.exp(-(F.col("logit") + F.lit(shift))))).otherwise(F.lit(0.0))
    out = scored.withColumn("score", value).withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
    return out.select(F.col("id").alias(id_col), held_out, "score", "predicted", "n_windows")


def cut(counts: dict[int, tuple[int, int]]) -> float:
    """The logit from which on predicting toxic has the highest F1 (in the
    middle of the lowest and the highest such step)."""
    if not counts:
        return 0.0
    toxic_total = sum(t for t, _ in counts.values())
    toxic = clean = 0
    tried = []
    for step in range(max(counts, default=0), min(counts, default=0) - 1, -1):
        t, c = counts.get(step, (0, 0))
        toxic, clean = toxic + t, clean + c
        tried.append((2 * toxic / (toxic + clean + toxic_total) if toxic else 0.0, step))
    best = max(f for f, _ in tried)
    steps = [s for f, s in tried if f == best]
    return (min(steps) + max(steps)) / 2 / STEPS_A_UNIT


def fitted(rows: DataFrame, told: DataFrame) -> tuple[Network | None, DataFrame]:
    """The network trained on windows of a bounded sample of labelled rows,
    and all other labelled rows, a fifth of all at least, to calibrate it."""
    some = None
    for label, most in FIT_DOCS.items():
        one = told.where(F.col("toxic") == label).where(F.pmod(F.xxhash64("known", F.lit(9)), F.lit(5)) > 0).orderBy(F.xxhash64("known"), "known").limit(most)
        some = one if some is None else some.unionByName(one)
    some = stored(some, "toxic-sample")  # at most the FIT_DOCS ids
    texts = rows.join(F.broadcast(some), rows["id"] == some["known"]).select("id", "text", "toxic")
    cut_up = stored(texts.mapInArrow(_windows, "id long, toxic int, turn int, window string"), "toxic-windows")
    sample = {}
    for label, most in FIT_WINDOWS.items():
        part = cut_up.where(F.col("toxic") == label).orderBy("turn", F.xxhash64("id"), F.xxhash64("window"), "window").limit(most)
        sample[label] = [(r["id"], r["window"]) for r in part.select("id", "window").collect()]
    net = Network.trained(sample[1], sample[0]) if sample[0] and sample[1] else None
    return net, told.join(F.broadcast(some.select("known")), "known", "left_anti")


def words_of(text: str) -> list[str]:
    return text.lower().split()


def starts_of(n: int) -> range:
    """Where the windows of n words start: together they cover all words."""
    return range(0, max(1, n - (WINDOW - ADVANCE)), ADVANCE) if n else range(0)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text its windows in an order of their own hashes: texts take
    turns in a bounded sample, so that long ones don't push out the others."""
    for batch in batches:
        out = []
        for i, text, toxic in zip(*(batch.column(c).to_pylist() for c in range(3))):
            words = words_of(text or "")
            cut_up = [" ".join(words[a : a + WINDOW]) for a in starts_of(len(words))]
            out += [(i, toxic, turn, w) for turn, w in enumerate(sorted(cut_up, key=lambda w: (zlib.crc32(w.encode()), w)))]
        cols = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["id", "toxic", "turn", "window"])


class _Codes(dict):
    """Numbers words in order of appearance; 0 is padding."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self) + 1
        return n


class Vocabulary:
    """Network inputs of the distinct words of some texts."""

    def __init__(self, words: list[str]):
        bare = [(w.strip(_MARKS) or w).encode() for w in words]
        self.word = np.fromiter((zlib.crc32(w) % WORDS for w in bare), np.int64, len(bare))
        self.start = np.fromiter((zlib.crc32(w.strip(_MARKS)[:START].encode()) % GRAMS for w in words), np.int64, len(bare))
        # characters as \2 word \3; a place is where a sequence of 3 starts,
        # and one of 4 if the word goes on
        raw = np.frombuffer(b"".join(b"\2" + w + b"\3" for w in bare) + b"\0", np.uint8).astype(np.uint32)
        size = np.fromiter(map(len, bare), np.int64, len(bare)) + 2
        end = np.cumsum(size)
        owner = np.repeat(np.arange(len(bare)), size)
        at = np.flatnonzero(np.arange(len(raw) - 1) + 3 <= end[owner])
        three = (raw[at] * np.uint32(0x9E3779B1)) ^ (raw[at + 1] * np.uint32(0x85EBCA77)) ^ (raw[at + 2] * np.uint32(0xC2B2AE3D))
        four = (three * np.uint32(5)) ^ (raw[at + 3] * np.uint32(0x27D4EB2F))
        mixed = lambda h: (((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(18)).astype(np.int64)
        self.three = mixed(three)
        self.four = np.where(at + 4 <= end[owner[at]], mixed(four), -1)
        self.owner = owner[at]
        self.places = np.bincount(self.owner, minlength=len(bare))
        self.first = np.cumsum(self.places) - self.places

    def __len__(self) -> int:
        return len(self.word)

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        """(words + 1, 2 * DIM); row 0 is padding."""
        out = np.zeros((len(self) + 1, 2 * DIM), np.float32)
        out[1:, :DIM] = p["word"][self.word]
        for a in range(0, len(self), 20_000):
            b = min(a + 20_000, len(self))
            i, j = self.first[a], self.first[b - 1] + self.places[b - 1]
            e = p["gram"][self.three[i:j]] + p["gram"][self.four[i:j]] * (self.four[i:j] >= 0)[:, None]
            out[a + 1 : b + 1, DIM:] = np.add.reduceat(e, self.first[a:b] - i) / self.places[a:b, None] + p["start"][self.start[a:b]]
        return out

    def spread(self, d: np.ndarray, grads: dict[str, np.ndarray]) -> None:
        """Adds the gradients of the inputs to those of the embeddings."""
        np.add.at(grads["word"], self.word, d[1:, :DIM])
        np.add.at(grads["start"], self.start, d[1:, DIM:])
        each = (d[1:, DIM:] / self.places[:, None])[self.owner]
        np.add.at(grads["gram"], self.three, each)
        with_four = self.four >= 0
        np.add.at(grads["gram"], self.four[with_four], each[with_four])


def coded(texts: list[list[str]]) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """The vocabulary, (windows, WINDOW) word numbers, and each window's text."""
    codes = _Codes()
    flat, owner, rows = [], [], []
    at = 0
    for i, words in enumerate(texts):
        flat.append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
        for s in starts_of(len(words)):
            owner.append(i)
            rows.append((at + s, at + len(words)))
        at += len(words)
    flat_all = np.concatenate([*flat, np.zeros(1, np.int64)])
    span = np.array(rows, np.int64).reshape(-1, 2)
    place = span[:, :1] + np.arange(WINDOW)
    inside = place < span[:, 1:]
    return Vocabulary(list(codes)), np.where(inside, flat_all[np.where(inside, place, 0)], 0), np.array(owner, np.int64)


class Network:
    """Parameters, and the passes.  Gates are in the order update, reset, new;
    the first axis of recurrent parameters is the direction."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        self.p = {
            # small, so that what training never met says little
            "word": draw(WORDS, DIM, s=0.02),
            "gram": draw(GRAMS, DIM, s=0.02),
            "start": draw(GRAMS, DIM, s=0.02),
            "in": draw(2, 2 * DIM, 3 * HIDDEN, s=0.4),
            "in_b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "rec": draw(2, HIDDEN, 3 * HIDDEN, s=0.3),
            "att": draw(2 * HIDDEN, ATTENTION, s=0.3),
            "att_b": np.zeros(ATTENTION, np.float32),
            "att_v": draw(ATTENTION, s=0.5),
            "out": draw(2 * HIDDEN, s=0.5),
            "out_b": np.zeros(1, np.float32),
        }

    def projected(self, inputs: np.ndarray) -> np.ndarray:
        """What each word adds to the gates, (2, words, 3 * HIDDEN); padding
        keeps the update gate shut, so that the state passes through."""
        out = np.matmul(inputs[None], self.p["in"]) + self.p["in_b"]
        out[:, 0] = 0
        out[:, 0, :HIDDEN] = 40
        return out

    def forward(self, gates: np.ndarray, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        n, h = len(x), np.zeros((2, len(x), HIDDEN), np.float32)
        states = np.empty((n, WINDOW, 2 * HIDDEN), np.float32)
        kept = []
        rec = self.p["rec"]
        for t in range(WINDOW):
            g = np.stack([gates[0][x[:, t]], gates[1][x[:, WINDOW - 1 - t]]])
            u = np.matmul(h, rec)
            zr = np.tanh(0.5 * (g[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN])) * np.float32(0.5) + np.float32(0.5)
            z, r, m = zr[..., :HIDDEN], zr[..., HIDDEN:], u[..., 2 * HIDDEN :]
            new = np.tanh(g[..., 2 * HIDDEN :] + r * m)
            if keep:
                kept.append((z, r, m, new, h))
            h = new + z * (h - new)
            states[:, t, :HIDDEN] = h[0]
            states[:, WINDOW - 1 - t, HIDDEN:] = h[1]
        u = np.tanh(states @ self.p["att"] + self.p["att_b"])
        e = np.where(x > 0, u @ self.p["att_v"], np.float32(-1e9))
        a = np.exp(e - e.max(1, keepdims=True))
        a /= a.sum(1, keepdims=True)
        c = np.einsum("nt,nth->nh", a, states)
        return c @ self.p["out"] + self.p["out_b"][0], {"steps": kept, "states": states, "u": u, "a": a, "c": c}

    def logits(self, vocabulary: Vocabulary, x: np.ndarray) -> np.ndarray:
        gates = self.projected(vocabulary.inputs(self.p))
        return np.concatenate([np.zeros(0, np.float32), *(self.forward(gates, x[i : i + 1024])[0] for i in range(0, len(x), 1024))])

    def gradients(self, vocabulary: Vocabulary, x: np.ndarray, y: np.ndarray, kept: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """``kept``: which inputs of each word (its own embedding, its
        characters) this pass sees, as factors (words + 1, 2)."""
        p, grads = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        seen = np.float32(1) if kept is None else np.repeat(kept, DIM, axis=1)
        inputs = vocabulary.inputs(p) * seen
        logit, f = self.forward(self.projected(inputs), x, keep=True)
        d = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        a, u, states = f["a"], f["u"], f["states"]
        grads["out"], grads["out_b"] = f["c"].T @ d, d.sum(keepdims=True)
        dc = d[:, None] * p["out"]
        da = np.einsum("nth,nh->nt", states, dc)
        de = a * (da - (a * da).sum(1, keepdims=True))
        du = de[..., None] * p["att_v"] * (1 - u * u)
        grads["att_v"], grads["att_b"] = np.einsum("nt,nta->a", de, u), du.sum((0, 1))
        grads["att"] = np.einsum("nth,nta->ha", states, du)
        dstates = a[..., None] * dc[:, None] + du @ p["att"].T
        dgates = np.zeros((2, len(inputs), 3 * HIDDEN), np.float32)
        dh = np.zeros((2, len(x), HIDDEN), np.float32)
        for t in range(WINDOW - 1, -1, -1):
            z, r, m, new, before = f["steps"][t]
            dh = dh + np.stack([dstates[:, t, :HIDDEN], dstates[:, WINDOW - 1 - t, HIDDEN:]])
            dnew = dh * (1 - z) * (1 - new * new)
            dz, dr = dh * (before - new) * z * (1 - z), dnew * m * r * (1 - r)
            dg, drec = np.concatenate([dz, dr, dnew], -1), np.concatenate([dz, dr, dnew * r], -1)
            grads["rec"] += np.matmul(before.transpose(0, 2, 1), drec)
            dh = dh * z + np.matmul(drec, p["rec"].transpose(0, 2, 1))
            np.add.at(dgates[0], x[:, t], dg[0])
            np.add.at(dgates[1], x[:, WINDOW - 1 - t], dg[1])
        dgates[:, 0] = 0
        grads["in"] = np.matmul(inputs.T[None], dgates)
        grads["in_b"] = dgates.sum(1, keepdims=True)
        vocabulary.spread(np.matmul(dgates, p["in"].transpose(0, 2, 1)).sum(0) * seen, grads)
        return grads

    @classmethod
    def trained(cls, toxic: list[tuple[int, str]], clean: list[tuple[int, str]], steps: int = 150, batch: int = 192, rate: float = 0.01) -> Network:
        """Windows with their text's id.  Which windows of a toxic text are so
        isn't known: first those with words and sequences that toxic texts
        have more often, later those that the network itself scores highest."""
        net, rng = cls(), np.random.default_rng(5)
        vocabulary, x, _ = coded([w.split() for _, w in [*toxic, *clean]])
        owner = np.concatenate([np.unique(np.array([i for i, _ in part]), return_inverse=True)[1] for part in (toxic, clean)])
        first = _lifts(vocabulary, x, owner, len(toxic))[: len(toxic)]
        owner = owner[: len(toxic)]
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
        t = 0
        for rounds in range(2):
            value = first if not rounds else net.logits(vocabulary, x[: len(toxic)])
            top = np.full(owner.max() + 1, -np.inf)
            np.maximum.at(top, owner, value)
            least = 0.7 * top[owner] if not rounds else np.minimum(top[owner], 0.0)
            yes, no = np.flatnonzero(value >= least), np.arange(len(toxic), len(x))
            for _ in range(steps):
                half = batch // 2
                rows = np.concatenate([rng.choice(yes, half), rng.choice(no, batch - half)])
                y = np.repeat([1.0, 0.0], [half, batch - half]).astype(np.float32)
                used, small = np.unique(x[rows], return_inverse=True)
                words, has_pad = used[used > 0] - 1, int(used[0] == 0)
                kept = (rng.random((len(words) + 1, 2)) > DROPPED).astype(np.float32) / np.float32(1 - DROPPED)
                grads = net.gradients(_part(vocabulary, words), small.reshape(len(rows), WINDOW) + (1 - has_pad), y, kept)
                t += 1
                lr = rate * min(1.0, t / 20) * (0.2 if t > 1.6 * steps else 1.0)
                for k, g in grads.items():
                    m, v = moment[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    net.p[k] -= (lr * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return net


def _part(v: Vocabulary, words: np.ndarray) -> Vocabulary:
    """The vocabulary of some of the words, in ascending order."""
    out = object.__new__(Vocabulary)
    out.word, out.start, out.places = v.word[words], v.start[words], v.places[words]
    at = np.repeat(v.first[words] - (np.cumsum(out.places) - out.places), out.places) + np.arange(int(out.places.sum()))
    out.three, out.four = v.three[at], v.four[at]
    out.owner, out.first = np.repeat(np.arange(len(words)), out.places), np.cumsum(out.places) - out.places
    return out


def _lifts(v: Vocabulary, x: np.ndarray, owner: np.ndarray, n_toxic: int) -> np.ndarray:
    """Each window's mean of its three highest word lifts; a word's is its own
    log odds to be in a toxic text, or those of its character sequences,
    whichever is higher, from SEEN_IN texts on."""
    seen = {}
    for label, rows in ((1, slice(n_toxic)), (0, slice(n_toxic, None))):
        pairs = np.unique(owner[rows, None] * np.int64(len(v) + 1) + x[rows])
        seen[label] = pairs // (len(v) + 1), pairs % (len(v) + 1)  # text, word

    def odds(key: np.ndarray, size: int, word: np.ndarray) -> np.ndarray:
        times, texts = np.zeros((2, size)), np.zeros((2, 1))
        first = np.searchsorted(word, np.arange(len(v) + 1))
        for label, (text, w) in seen.items():
            text, w = text[w > 0], w[w > 0] - 1
            n = first[w + 1] - first[w]
            at = np.repeat(first[w] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            has = np.unique(np.repeat(text, n) * np.int64(size) + key[at])
            times[label] = np.bincount(has % size, minlength=size)
            texts[label] = len(np.unique(text))
        share = (times + 0.2) / (texts + 1)
        return np.where(times.sum(0) >= SEEN_IN, np.log(share[1] / share[0]), 0.0)

    lift = odds(v.word, WORDS, np.arange(len(v)))[v.word]
    lift = np.maximum(lift, odds(v.start, GRAMS, np.arange(len(v)))[v.start])
    with_four = v.four >= 0
    grams = odds(v.four[with_four], GRAMS, v.owner[with_four])[v.four[with_four]]
    np.maximum.at(lift, v.owner[with_four], grams)
    of = np.concatenate([[0.0], lift])[x]
    return np.sort(of, axis=1)[:, -3:].mean(1)


def _logits(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vocabulary, x, owner = coded([words_of(t or "") for t in batch.column(1).to_pylist()])
            top = np.full(batch.num_rows, -1e9)
            np.maximum.at(top, owner, net.logits(vocabulary, x))
            counts = np.bincount(owner, minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(top), pa.array(counts)], names=["id", "logit", "n_windows"])

    return run
