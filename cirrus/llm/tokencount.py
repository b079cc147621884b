"""Token counts without token ids.

Pieces are counted once per distinct pre-token of the corpus and joined to
the documents' pre-token frequencies:

1. every block of documents (part of one input partition) becomes one row
   per distinct pre-token, with its postings (document in block, frequency);
2. rows are shuffled by pre-token and sorted by block range and pre-token, so
   each distinct pre-token meets its postings from all blocks of a range in
   one run of one task: its pieces are counted once, multiplied with the
   frequencies and summed per document; at the end of a range the task passes
   on one row for each of its blocks, of the documents that it has sums of;
3. the partial sums of a block meet with its document ids.

A pre-token has one row per block however often it occurs, so a very common
one is not a hot key.  A block has one row of partial sums from each task at
most, together no longer than its postings, however many blocks there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.llm import bytebpe
from cirrus.llm.common import bounded_batches

#: Documents of one block; a posting is document + BLOCK_DOCS * frequency.
BLOCK_DOCS = 1 << 13
BLOCK_CHARS = 48 << 20
_MOST = (1 << 31) // BLOCK_DOCS - 1
#: A block range, whose sums a task holds at a time: so many partitions, and
#: of each so many blocks.
RANGE_PARTS, RANGE_BLOCKS = 32, 8

_BLOCKS = "token string, range long, block long, postings array<int>, ids array<long>, bytes array<long>"


def token_counts(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``tokenizer``: path of a byte-level BPE file that every executor can
    read.  Special strings in a text count as one token, none are added.
    Null and empty texts have 0 bytes and 0 tokens; every row counts by
    itself, repeated rows and null ids included, very long texts whole; other
    columns are ignored; an empty table gives no rows.
    ``docs`` must give the same partitions each time it is read (files, or a
    stored table), as a lost partition is made again.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sums = partial_sums(rows, tokenizer)
    out = sums.groupBy("block").applyInArrow(_documents, "id long, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def partial_sums(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Of (id, text) rows: one row a block with its documents' ids and bytes,
    and at most one from each task with the tokens that the task has counted
    in them; ``docs``: the documents that the sums are of, null for all."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = rows.mapInArrow(_blocks(tokenizer), _BLOCKS)
    runs = postings.repartition(width, "token").sortWithinPartitions("range", "token")
    return runs.mapInArrow(_piece_sums(tokenizer), "block long, docs array<short>, sums array<long>, ids array<long>, bytes array<long>")


class _Codes(dict):
    """Numbers its keys in order of appearance."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class _PartCodes(_Codes):
    def __init__(self):
        self.odd: set[int] = set()

    def __missing__(self, key):
        n = super().__missing__(key)
        if bytebpe.odd(key):
            self.odd.add(n)
        return n


def _blocks(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bytebpe.opened(tokenizer)
        first = TaskContext.get().partitionId() << 32
        n, block = 0, _Block(bpe, first)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.add(i, text or "")
                if block.full():
                    yield from block.rows()
                    n += 1
                    block = _Block(bpe, first + n)
        if block.ids:
            yield from block.rows()

    return run


class _Block:
    def __init__(self, bpe: bytebpe.ByteBpe, number: int):
        self.bpe, self.number = bpe, number
        self.ids: list[int | None] = []
        self.bytes: list[int] = []
        self.chars = 0
        self.codes = _PartCodes()
        self.found: list[np.ndarray] = []  # part code * BLOCK_DOCS + document
        self.times: list[np.ndarray] = []
        self.special: dict[tuple[str, int], int] = {}

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.chars >= BLOCK_CHARS

    def add(self, doc_id: int | None, text: str) -> None:
        at = len(self.ids)
        self.ids.append(doc_id)
        self.bytes.append(len(text.encode()))
        self.chars += len(text)
        for is_special, run in self.bpe.runs(text):
            if is_special:
                self.special[run, at] = self.special.get((run, at), 0) + 1
            elif run:
                codes = list(map(self.codes.__getitem__, bytebpe.cut_at_spaces(run)))
                if self.codes.odd and not self.codes.odd.isdisjoint(codes):
                    codes = list(map(self.codes.__getitem__, bytebpe.parts(run)))
                code, times = np.unique(np.array(codes, np.int64), return_counts=True)
                self.found.append(code * BLOCK_DOCS + at)
                self.times.append(times)

    def rows(self) -> Iterator[pa.RecordBatch]:
        tokens = _Codes()
        of_part = [[tokens[t] for t in self.bpe.pretokens_of(p)] if not bytebpe.odd(p) else [] for p in self.codes]
        lengths = np.fromiter(map(len, of_part), np.int64, len(of_part))
        flat = np.fromiter((t for ts in of_part for t in ts), np.int64, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        found = np.concatenate(self.found) if self.found else np.zeros(0, np.int64)
        times = np.concatenate(self.times) if self.times else np.zeros(0, np.int64)
        part, doc = found // BLOCK_DOCS, found % BLOCK_DOCS
        n = lengths[part]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        token = flat[np.repeat(starts[part], n) + within]
        key, weight = token * BLOCK_DOCS + np.repeat(doc, n), np.repeat(times, n)
        extra = [(tokens[s] * BLOCK_DOCS + at, k) for (s, at), k in self.special.items()]
        if extra:
            key = np.concatenate([key, np.array([e[0] for e in extra], np.int64)])
            weight = np.concatenate([weight, np.array([e[1] for e in extra], np.int64)])
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        key, weight = key[new], np.add.reduceat(weight, new) if len(new) else weight
        while len(over := np.flatnonzero(weight > _MOST)):  # as several postings
            key = np.concatenate([key, key[over]])
            weight = np.concatenate([weight, weight[over] - _MOST])
            weight[over] = _MOST
            order = np.argsort(key, kind="stable")
            key, weight = key[order], weight[order]
        token, posting = key // BLOCK_DOCS, (key % BLOCK_DOCS + weight * BLOCK_DOCS).astype(np.int32)
        bounds = np.searchsorted(token, np.arange(len(tokens) + 1))
        names = list(tokens)
        for a in range(0, len(names), 20_000):
            b = min(a + 20_000, len(names))
            offsets = (bounds[a : b + 1] - bounds[a]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(posting[bounds[a] : bounds[b]]))
            yield _batch(names[a:b], self.number, lists, None, None)
        # the block's documents travel under a name that is no pre-token, as
        # a control character and a letter never stand in one
        yield _batch([f"\x01block{self.number}"], self.number, None, [self.ids], [self.bytes])


def _range(block: int) -> int:
    part, n = block >> 32, block & 0xFFFFFFFF
    return (part // RANGE_PARTS << 32) + n // RANGE_BLOCKS


def _batch(tokens, block, postings, ids, sizes) -> pa.RecordBatch:
    n = len(tokens)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(tokens, pa.string()),
            pa.array(np.full(n, _range(block))),
            pa.array(np.full(n, block)),
            postings if postings is not None else pa.nulls(n, pa.list_(pa.int32())),
            pa.array(ids, pa.list_(pa.int64())) if ids else pa.nulls(n, pa.list_(pa.int64())),
            pa.array(sizes, pa.list_(pa.int64())) if sizes else pa.nulls(n, pa.list_(pa.int64())),
        ],
        names=["token", "range", "block", "postings", "ids", "bytes"],
    )


_SUMS = pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.int16())), ("sums", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("bytes", pa.list_(pa.int64()))])


def _piece_sums(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bytebpe.opened(tokenizer)
        slots, sums = _Codes(), np.zeros((0, BLOCK_DOCS), np.int64)
        last, pieces, now = None, 0, None
        for whole in batches:
            ranges = np.asarray(whole.column(1))
            cuts = [0, *(np.flatnonzero(np.diff(ranges)) + 1), len(ranges)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if ranges[a] != now:
                    yield from _passed_on(slots, sums)
                    slots, sums, now = _Codes(), np.zeros((0, BLOCK_DOCS), np.int64), ranges[a]
                batch = whole.slice(a, b - a)
                tokens, blocks, postings = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
                infos = [i for i, t in enumerate(tokens) if t.startswith("\x01block")]
                if infos:
                    none = [pa.nulls(len(infos), _SUMS.field(c).type) for c in ("docs", "sums")]
                    yield pa.RecordBatch.from_arrays([pa.array([blocks[i] for i in infos]), *none, *(batch.column(c).take(pa.array(infos)) for c in (4, 5))], schema=_SUMS)
                counts = np.zeros(len(tokens), np.int64)
                for i, t in enumerate(tokens):
                    if t != last:
                        last, pieces = t, bpe.count(t) if postings[i].is_valid else 0
                    counts[i] = pieces
                slot = np.fromiter((slots[b] for b in blocks), np.int64, len(blocks))
                if len(slots) > len(sums):
                    sums = np.concatenate([sums, np.zeros((len(slots) - len(sums), BLOCK_DOCS), np.int64)])
                value = np.asarray(postings.flatten())
                n = np.asarray(postings.value_lengths().fill_null(0))
                key = np.repeat(slot, n) * BLOCK_DOCS + value % BLOCK_DOCS
                np.add.at(sums.reshape(-1), key, np.repeat(counts, n) * (value // BLOCK_DOCS))
        yield from _passed_on(slots, sums)

    return run


def _passed_on(slots: dict, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block, i in slots.items():
        used = np.flatnonzero(sums[i])
        if len(used):
            few = 2 * len(used) < used[-1]
            docs = pa.array([used.astype(np.int16) if few else None], pa.list_(pa.int16()))
            one = pa.array([sums[i, used] if few else sums[i, : used[-1] + 1]], pa.list_(pa.int64()))
            none = pa.nulls(1, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), docs, one, none, none], schema=_SUMS)


def _documents(table: pa.Table) -> pa.Table:
    total, ids, sizes = np.zeros(BLOCK_DOCS, np.int64), [], []
    for batch in table.to_batches():
        for i in range(batch.num_rows):
            if batch.column(2)[i].is_valid:
                part, docs = np.asarray(batch.column(2)[i].values), batch.column(1)[i]
                total[np.asarray(docs.values) if docs.is_valid else slice(len(part))] += part
            else:
                ids, sizes = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
    return pa.table({"id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()), "n_tokens": total[: len(ids)]})
