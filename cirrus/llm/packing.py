"""Best-fit packing of token sequences, planned over the length histogram.

Documents become pieces of at most ``capacity`` tokens in one pass over the
text.  Only the histogram of piece lengths (at most ``capacity`` counts)
reaches the driver, where best-fit decreasing places whole counts of equal
lengths at a time.  Its plan is a list of runs of slots; pieces take slots
by joining on (length, rank within length).
"""

from __future__ import annotations

import bisect
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.llm import bytebpe
from cirrus.llm.common import bounded_batches, give_back, running_sum, stored

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Parts of texts whose ids one Python process remembers, twice over.
REMEMBERED = 160_000
#: Bytes that mark by their hashes which parts have come once.
SEEN = 1 << 22
#: Slots that one planned row stands for at most, so that no task makes a
#: whole length's slots.
SLOTS_A_ROW = 4096


def pack(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where every piece of every document goes: (doc_id, piece, start,
    length, ids_crc32, sequence_id, offset).

    A document is its ids followed by ``end_id``; null and empty texts are
    ``end_id`` alone.  One longer than ``capacity`` is cut into pieces of
    ``capacity`` from its end, so that its first piece may be shorter.
    Every row is packed, repeated rows and null ids too; other columns are
    ignored.  An empty table gives no pieces.
    """
    bounded_batches(docs.sparkSession)
    pieces = stored(pieces_of(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    return place(pieces, capacity).withColumnRenamed("doc_id", id_col)


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer, capacity, end_id), _PIECES)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with doc_id, piece and length; a stored table) in as few
    sequences as best-fit decreasing needs, with sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(spark, best_fit(histogram, capacity))
    ordered = pieces.withColumn("_one", F.lit(1).cast("long"))
    rest = [F.col(c) for c in pieces.columns if c not in ("length",)]
    ranked = running_sum(ordered, ["length"], rest, "_one", "rank")
    joined = ranked.join(slots, ["length", "rank"])
    return joined.select(*pieces.columns, "sequence_id", "offset")


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs of slots (length, first rank, count, first sequence, offset).

    Best-fit decreasing over counts: lengths go from the longest down; as
    many pieces of a length as there are open sequences with the tightest
    room that still takes it are placed at once.  A sequence's content only
    matters through its room, so sequences are held as runs of numbers by
    room; the number of runs depends on the lengths, not on the documents.
    """
    if bad := [n for n in histogram if not 0 < n <= capacity]:
        raise ValueError(f"lengths outside 1..{capacity}: {bad[:5]}")
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: runs (first sequence, count)
    open_rooms: list[int] = []
    plan, opened = [], 0

    def put(room: int, first: int, count: int) -> None:
        if room:
            if not rooms[room]:
                bisect.insort(open_rooms, room)
            rooms[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(open_rooms, length)
            if at < len(open_rooms):
                room = open_rooms[at]
                first, count = rooms[room].pop()
                if not rooms[room]:
                    open_rooms.pop(at)
                fit = room // length  # a sequence takes all it can: it stays the tightest
                whole = min(count, left // fit)
                if whole:
                    for k in range(fit):
                        plan.append((length, rank, whole, first, capacity - room + k * length))
                        rank += whole
                    left -= whole * fit
                    put(room - fit * length, first, whole)
                if whole < count:
                    if 0 < left < fit:  # one more takes the rest of this length
                        for k in range(left):
                            plan.append((length, rank, 1, first + whole, capacity - room + k * length))
                            rank += 1
                        put(room - left * length, first + whole, 1)
                        left, whole = 0, whole + 1
                    if whole < count:
                        put(room, first + whole, count - whole)
            else:
                fresh = -(-left // (capacity // length))
                put(capacity, opened, fresh)
                opened += fresh
    return plan


def _slots(spark: SparkSession, plan: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """One row per planned slot, made by the executors."""
    schema = "length long, first_rank long, n long, first_sequence long, offset long"
    runs = spark.createDataFrame(plan, schema)
    blocks = runs.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SLOTS_A_ROW).cast("long"))))
    blocks = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "length", "first_rank", "_at")
    one = blocks.withColumn("_i", F.explode(F.sequence("_at", F.least(F.col("n"), F.col("_at") + SLOTS_A_ROW) - 1)))
    return one.select("length", (F.col("first_rank") + F.col("_i")).alias("rank"), (F.col("first_sequence") + F.col("_i")).alias("sequence_id"), "offset")


class _Bytes(dict):
    """Ids of each part of a text as little-endian bytes; None marks an odd
    part.  A part is kept when it comes for the second time, as most of them
    come once only; when the dictionary is full, only parts that come again
    are kept."""

    def __init__(self, bpe: bytebpe.ByteBpe):
        self.bpe, self.before, self.seen = bpe, {}, bytearray(SEEN)

    def __missing__(self, part: str) -> bytes | None:
        out = self.before.get(part, self)  # itself: not there
        if out is self:
            out = None if bytebpe.odd(part) else self.bpe.ids_of(part)
            if len(part) > 64:  # these hardly come again
                return out
            at = hash(part) % SEEN
            if not self.seen[at]:
                self.seen[at] = 1
                return out
        self[part] = out
        return out

    def of(self, text: str) -> bytes:
        out = []
        for is_special, run in self.bpe.runs(text):
            if is_special:
                out.append(array("I", [self.bpe.special[run]]).tobytes())
            elif run:
                try:
                    out.append(b"".join(map(self.__getitem__, bytebpe.cut_at_spaces(run))))
                except TypeError:  # None among them: an odd part
                    out.append(b"".join(map(self.__getitem__, bytebpe.parts(run))))
        if len(self) > REMEMBERED:
            self.before, self.seen = dict(self), bytearray(SEEN)
            self.clear()
        return b"".join(out)


_KNOWN: dict[str, _Bytes] = {}


def remembered(tokenizer: str) -> _Bytes:
    """The ids that this Python process knows, kept from task to task."""
    if tokenizer not in _KNOWN:
        _KNOWN[tokenizer] = _Bytes(bytebpe.opened(tokenizer))
    return _KNOWN[tokenizer]


def _cut(tokenizer: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered(tokenizer)
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are handled as little-endian unsigned 32-bit integers")
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = known.of(text or "") + end
                n = len(ids) // 4
                at = 0
                upto = n % capacity or capacity
                k = 0
                while at < n:
                    out.append((doc_id, k, at, upto - at, zlib.crc32(ids[4 * at : 4 * upto])))
                    at, upto, k = upto, upto + capacity, k + 1
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return run
