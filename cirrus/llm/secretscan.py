"""Secret scan: fixed patterns, and a character convolutional network over
every candidate string (run of CANDIDATE_LEAST or more secret-like characters)
with its surroundings.

The patterns' spans always stand.  The network adds candidates that look and
are introduced like labelled secrets; it is trained in numpy on a bounded
sample of half of the labelled findings, and its threshold is the highest that
keeps the recall asked for over all of the other half, the patterns' values of
any length; copies of a window count once in both.  Runs that no pattern has,
but that are introduced or made up like secrets, are scored and no examples of
clean ones; clean examples come from CLEAN_ROWS sampled texts.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import bounded_batches, give_back, stored

#: Kinds in order, their patterns, the least characters.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run that reaches HEX_LEAST is a greedy run that isn't dropped for length.
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)

#: A candidate is a whole run of these characters.
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
CANDIDATE_LEAST = 8
#: What a run is: unmatched, the value of a pattern, another part of a
#: pattern's span, unmatched but perhaps a secret.
CLEAN, SECRET, TOUCHED, DOUBTFUL = range(4)
_INTRODUCES = re.compile(r"pass|pwd|secret|token|key|bearer|auth|credential", re.I | re.A)
_PIECE = re.compile(r"[A-Za-z0-9]{16,}")
LEFT, BODY, RIGHT = 24, 40, 8
#: Characters by which the windows of a long candidate advance.
ADVANCE = 32

#: Different windows that the network is trained on, at most, of each label.
FIT_ROWS = 4000
#: Texts, about, that clean windows are drawn from: those with the least
#: hashes, so that copies are in it or out of it together.
CLEAN_ROWS = 20_000
RECALL = 0.99
SCORE_STEPS = 2000

_LABELLED = "window string, label int, place long"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """One row per document: counts of the pattern kinds, ``base`` and
    ``found`` as arrays of (kind, start, end) in code points, end exclusive;
    kind "network" for what the network adds.

    ``labelled``: (window, label), windows as :func:`windows_of` cuts them.
    Without it the findings of ``docs`` itself are used, labelled by whether
    a pattern matched, doubtful ones left out (then ``docs`` is read twice).  With no labelled findings of both kinds the network
    adds nothing.  Null texts are empty; null ids and repeated rows are
    scanned like any other, very long texts whole; other columns are ignored;
    an empty table gives no rows.
    """
    net, least = fitted(docs, text_col, labelled)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_found(net, least), "id long, n_assign long, n_access long, n_hex long, base array<struct<k:string,s:int,e:int>>, found array<struct<k:string,s:int,e:int>>, best double")
    return out.withColumnRenamed("id", id_col)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span that :func:`scan` finds replaced by ``mark``
    (overlapping spans by one); all else, null texts included, as it is."""
    net, least = fitted(docs, text_col, labelled)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        spans = spans_of(net, least, list(texts))
        give_back()
        return pd.Series([t if t is None else _replaced(t, [x[1:] for x in base] + more, mark) for t, (base, more, _) in zip(texts, spans)], dtype=object)

    return docs.withColumn(text_col, clean(F.col(text_col)))


def spans_of(net: Net | None, least: float, texts: list[str | None]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int]], float]]:
    """Of each text: the patterns' spans, those that the network adds, and
    the highest score."""
    base = [base_spans(t or "") for t in texts]
    if net is None:
        return [(b, [], 0.0) for b in base]
    runs = [[r for r in runs_of(t or "", b) if r[2] != TOUCHED] for t, b in zip(texts, base)]
    cut = [[windows_of(t, s, e) for s, e, _ in rs] for t, rs in zip(texts, runs)]
    different = list(dict.fromkeys(w for ws in cut for each in ws for w in each))
    score = dict(zip(different, net.score(different).tolist()))
    out = []
    for b, rs, ws in zip(base, runs, cut):
        tops = [max(score[w] for w in each) for each in ws]
        out.append((b, [(s, e) for (s, e, label), top in zip(rs, tops) if label != SECRET and top >= least], max(tops, default=0.0)))
    return out


def _replaced(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def fitted(docs: DataFrame, text_col: str, labelled: DataFrame | None) -> tuple[Net | None, float]:
    """The network, and the score from which on it adds a candidate."""
    bounded_batches(docs.sparkSession)
    if labelled is None:
        texts = docs.select(F.col(text_col).alias("text"))
        share = min(1.0, CLEAN_ROWS / max(1, docs.count()))
        labelled = stored(texts.mapInArrow(_labelled(share), _LABELLED), "secrets")
    else:
        labelled = labelled.select("window", "label", F.crc32(F.encode("window", "UTF-8")).alias("place"))
    labelled = labelled.where("window IS NOT NULL AND label IS NOT NULL").distinct()
    secrets = labelled.where(F.col("label") == SECRET)
    halves = secrets.where(F.col("place") % 2 == 0), secrets.where(F.col("place") % 2 == 1)
    if halves[0].isEmpty() or halves[1].isEmpty():
        halves = secrets, secrets  # hardly any
    sample = []
    for some in (labelled.where(F.col("label") == CLEAN), halves[0]):
        sample.append([r["window"] for r in some.orderBy("place", "window").limit(FIT_ROWS).collect()])
    if not all(sample):
        return None, 2.0
    clean, secret = sample
    net = Net.trained(clean, secret + elsewhere(secret, clean))
    tried = halves[1].select("window").mapInArrow(_steps(net), "step int")
    return net, threshold({r["step"]: r["count"] for r in tried.groupBy("step").count().collect()})


def elsewhere(secret: list[str], clean: list[str]) -> list[str]:
    """The secrets, some cut to their ends, in the surroundings of clean runs,
    so that the network knows them in other forms than the patterns'."""
    rng, out = np.random.default_rng(13), []
    for window in secret:
        around = clean[int(rng.integers(len(clean)))]
        body = window[LEFT : LEFT + BODY].rstrip()
        n = int(rng.integers(min(len(body), max(CANDIDATE_LEAST, len(body) // 2)), len(body) + 1))
        out.append(around[:LEFT] + body[len(body) - n :].ljust(BODY) + around[LEFT + BODY :])
    return out


def digest(found: DataFrame) -> DataFrame:
    """``base_sha256`` and ``spans`` in place of the span arrays."""
    line = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    out = found.withColumn("base_sha256", F.sha2(line(F.col("base")), 256)).withColumn("spans", line(F.col("found")))
    return out.drop("base", "found")


def threshold(counts: dict[int, int]) -> float:
    """The highest step that RECALL of the counted findings reach."""
    total, seen = sum(counts.values()), 0
    for step in sorted(counts, reverse=True):
        seen += counts[step]
        if seen >= RECALL * total:
            return step / SCORE_STEPS
    return 2.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], x[0]))


def runs_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, what it is) of all candidates, and of shorter runs with
    the value of a pattern; ``base``: the patterns' spans in the text."""
    values = sorted((ASSIGN.match(text, s).start(2) if KINDS[k] == "assign" else s, e) for k, s, e in base)
    reach = _joined([(s, e) for _, s, e in base])
    values, v, r, out = _joined(values), 0, 0, []
    for m in _RUN.finditer(text):
        s, e = m.span()
        while v < len(values) and values[v][1] <= s:
            v += 1
        while r < len(reach) and reach[r][1] <= s:
            r += 1
        if v < len(values) and values[v][0] < e:
            out.append((s, e, SECRET))
        elif e - s >= CANDIDATE_LEAST:
            touched = r < len(reach) and reach[r][0] < e
            out.append((s, e, TOUCHED if touched else DOUBTFUL if _doubtful(text, s, e) else CLEAN))
    return out


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _doubtful(text: str, start: int, end: int) -> bool:
    """Introduced by a word that introduces secrets, or with a long piece of
    letters and digits, or of letters in changing case."""
    if _INTRODUCES.search(text, max(0, start - LEFT), end if "=" in text[start:end] else start):
        return True
    for m in _PIECE.finditer(text, start, end):
        piece = m.group()
        digit, rest = any(c.isdigit() for c in piece), piece[1:]
        if digit and not piece.isdigit() or not digit and not rest.islower() and not piece.isupper():
            return True
    return False


def windows_of(text: str, start: int, end: int) -> list[str]:
    """What the network sees of a candidate: LEFT characters before, BODY of
    it, RIGHT after, as many windows as cover it, padded with spaces."""
    out = []
    for at in range(start, max(start + 1, end - (BODY - ADVANCE)), ADVANCE):
        upto = min(end, at + BODY)
        before = text[max(0, at - LEFT) : at].rjust(LEFT)
        out.append(before + text[at:upto].ljust(BODY) + text[upto : upto + RIGHT].ljust(RIGHT))
    return out


def _labelled(share: float):
    """The different windows of a batch's secret runs; of the clean ones in
    about ``share`` of the texts the FIT_ROWS different windows of the
    partition that come first by their place."""

    def rows(found: list[tuple[int, str]], label: int) -> pa.RecordBatch:
        windows, places = [w for _, w in found], [p for p, _ in found]
        return pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), pa.array([label] * len(found), pa.int32()), pa.array(places, pa.int64())], names=["window", "label", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: list[tuple[int, str]] = []
        last = 1 << 32
        for batch in batches:
            secret, some = set(), set(first)
            for text in batch.column(0).to_pylist():
                text = text or ""
                base, drawn = base_spans(text), zlib.crc32(text.encode()) < share * (1 << 32)
                if not base and not drawn:
                    continue
                for s, e, label in runs_of(text, base):
                    if label == SECRET or label == CLEAN and drawn:
                        for w in windows_of(text, s, e):
                            place = zlib.crc32(w.encode())
                            if label == SECRET:
                                secret.add((place, w))
                            elif place <= last:
                                some.add((place, w))
            first = heapq.nsmallest(FIT_ROWS, some)
            if len(first) == FIT_ROWS:
                last = first[-1][0]
            yield rows(list(secret), SECRET)
        yield rows(first, CLEAN)

    return run


class Net:
    """Width-5 convolution over one-hot characters, ReLU, maximum over the
    candidate, over what is before it and over what follows, two dense layers."""

    WIDTH, FILTERS, HIDDEN, LETTERS = 5, 12, 16, 98
    LENGTH = LEFT + BODY + RIGHT

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f32 = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        self.p = {
            "conv": f32(self.WIDTH, self.LETTERS, self.FILTERS, s=0.2),
            "conv_b": np.zeros(self.FILTERS, np.float32),
            "w1": f32(3 * self.FILTERS, self.HIDDEN, s=0.2),
            "b1": np.zeros(self.HIDDEN, np.float32),
            "w2": f32(self.HIDDEN, s=0.2),
            "b2": np.zeros(1, np.float32),
        }

    @classmethod
    def codes(cls, windows: list[str]) -> np.ndarray:
        """Printable ASCII by itself, other white space, other characters."""
        points = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(len(windows), cls.LENGTH)
        return np.where((points >= 32) & (points < 127), points - 32, np.where(points < 32, 95, 96)).astype(np.int64)

    def _pairs(self) -> list[np.ndarray]:
        """What each two adjacent characters add at places 0, 1 and 2, 3."""
        c = self.p["conv"]
        return [(c[k][:, None] + c[k + 1][None]).reshape(-1, self.FILTERS) for k in (0, 2)]

    def _forward(self, x: np.ndarray, pairs: list[np.ndarray] | None = None) -> dict[str, np.ndarray]:
        p, steps = self.p, self.LENGTH - self.WIDTH + 1
        if pairs is None:
            z = p["conv_b"] + sum(p["conv"][k][x[:, k : k + steps]] for k in range(self.WIDTH))
        else:  # the same in fewer steps
            two = x[:, :-1] * self.LETTERS + x[:, 1:]
            z = p["conv"][4].take(x[:, 4:], axis=0) + p["conv_b"]
            for k, table in zip((0, 2), pairs):
                z += table.take(two[:, k : k + steps], axis=0)
        inside = slice(LEFT, LEFT + BODY - self.WIDTH + 1)
        body, ctx, after = z[:, inside], z[:, :LEFT], z[:, inside.stop :]
        at = [body.argmax(1) + LEFT, ctx.argmax(1), after.argmax(1) + inside.stop]
        pooled = np.concatenate([body.max(1), ctx.max(1), after.max(1)], axis=1)
        a = np.maximum(pooled, 0)
        h = np.maximum(a @ p["w1"] + p["b1"], 0)
        return {"at": np.concatenate(at, axis=1), "pooled": pooled, "a": a, "h": h, "logit": h @ p["w2"] + p["b2"][0]}

    def score(self, windows: list[str]) -> np.ndarray:
        out, pairs = [np.zeros(0)], self._pairs() if len(windows) > 512 else None
        for a in range(0, len(windows), 256):
            out.append(1 / (1 + np.exp(-self._forward(self.codes(windows[a : a + 256]), pairs)["logit"].astype(float))))
        return np.concatenate(out)

    @classmethod
    def trained(cls, clean: list[str], secret: list[str], batch: int = 128, rate: float = 0.003, steps: int = 1600) -> Net:
        net, rng = cls(), np.random.default_rng(11)
        x = cls.codes(clean + secret)
        y = np.repeat([0.0, 1.0], [len(clean), len(secret)]).astype(np.float32)
        weight = np.where(y == 1, 0.5 / len(secret), 0.5 / len(clean)).astype(np.float32) * len(y)
        m = {k: np.zeros_like(v) for k, v in net.p.items()}
        v = {k: np.zeros_like(w) for k, w in net.p.items()}
        t = 0
        while t < steps:
            order = rng.permutation(len(y))
            for i in range(0, len(y), batch):
                rows = order[i : i + batch]
                grads = net._gradients(x[rows], y[rows], weight[rows])
                t += 1
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    net.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return net

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        f, p, n = self._forward(x), self.p, len(y)
        d = ((1 / (1 + np.exp(-f["logit"])) - y) * weight / n).astype(np.float32)
        dh = np.outer(d, p["w2"]) * (f["h"] > 0)
        da = (dh @ p["w1"].T) * (f["pooled"] > 0)
        conv = np.zeros_like(p["conv"])
        filters = np.tile(np.arange(self.FILTERS), 3)[None, :].repeat(n, 0)
        rows = np.arange(n)[:, None]
        for k in range(self.WIDTH):
            np.add.at(conv[k], (x[rows, f["at"] + k], filters), da)
        bias = da.reshape(n, 3, self.FILTERS).sum((0, 1))
        return {"conv": conv, "conv_b": bias, "w1": f["a"].T @ dh, "b1": dh.sum(0), "w2": f["h"].T @ d, "b2": d.sum(keepdims=True)}


def _steps(net: Net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.floor(net.score(batch.column(0).to_pylist()) * SCORE_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step)], names=["step"])

    return run


def _found(net: Net | None, least: float):
    span = pa.list_(pa.struct([("k", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, found, best = [], [], []
            for base, added, top in spans_of(net, least, batch.column(1).to_pylist()):
                mine = [{"k": KINDS[k], "s": s, "e": e} for k, s, e in base]
                more = [{"k": "network", "s": s, "e": e} for s, e in added]
                order = {k: i for i, k in enumerate((*KINDS, "network"))}
                bases.append(mine)
                found.append(sorted(mine + more, key=lambda x: (x["s"], order[x["k"]])))
                best.append(top)
            counts = [pa.array([sum(x["k"] == k for x in b) for b in bases], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(bases, span), pa.array(found, span), pa.array(best, pa.float64())], names=["id", "n_assign", "n_access", "n_hex", "base", "found", "best"])

    return run


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
