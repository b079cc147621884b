"""Phrase collocations by direct-address tiling.

1. Texts become streams of words, cut into blocks; a block
   begins with the last words of the one before, so that a phrase is counted
   where it ends.  A block numbers its words by itself.
2. Words are dealt to lists by their hash and counted per language; those
   with ``least`` occurrences are numbered by frequency.  A phrase with ``least`` occurrences has no other
   words, so blocks are rewritten with these numbers and gaps.
3. Adjacent numbers are pairs.  The number space is split into square tiles
   of tile x tile pairs: those of the most frequent numbers are counted
   directly by address (numpy bincount into a dense tile), all others as
   sorted coordinate lists.  Each block is counted first, blocks are then
   summed per tile.
4. Frequent pairs are numbered by frequency again, blocks rewritten with
   them, and adjacent ones counted in the same way: two phrases of m words
   that share m - 1 make a phrase of m + 1.
5. Every frequent phrase has the counts of its beginnings from its first
   part and those of its ends from its second; scores are exact decimals.

Words and pairs travel packed, a row per block and list or tile.  Nothing is
gathered but tile sums (a million numbers), the different words of one list or
pairs of one bucket of sparse tiles, and one block at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cirrus.llm.common import bounded_batches, numbered, stored



@dataclass(frozen=True)
class Sizes:
    """None of them changes a result."""

    #: Words of a block, and bytes of a text that are cut into words at a time.
    block: int = 1 << 20
    segment: int = 8 << 20
    #: Side of a tile; so many tiles of the most frequent numbers are dense
    #: along each side.
    tile: int = 1024
    side: int = 8
    #: Tasks that share one dense tile at first, and different pairs that one
    #: bucket of sparse tiles is planned for.
    salts: int = 16
    bucket: int = 4 << 20
    #: Lists that words are dealt to, at most.
    lists: int = 4096

    @property
    def dense(self) -> int:
        """How many dense tiles there are: their numbers are below."""
        return self.side * self.side


#: What ends a piece, and what separates words inside it.
_ENDS, _GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: No byte of UTF-8: stands for the end of a piece.
_END = b"\xff"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _GAPS + _ENDS, bytes(range(97, 123)) + b" " * len(_GAPS) + _END * len(_ENDS))


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang", sizes: Sizes = Sizes()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the ``top``
    phrases of 2 to ``longest`` words by score.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line
    ends, pieces into words at spaces and tabs.  ``a``: occurrences of the
    phrase, overlapping ones included, at least ``least``; ``l`` and ``r``: of
    its two parts at the cut with the lowest score, the first of those that
    tie; ``n``: all words of the language; score: floor(1000 a n / (l r)).
    Phrases inside a longer one that has ``percent`` % of their occurrences
    are left out.  Null texts are empty, a null language is ``und``; repeated
    rows and ties count each by themselves; other columns are ignored; an
    empty table gives no rows.
    """
    phrases, words = frequent(docs, least, longest, text_col, lang_col, sizes)
    out = None
    for m in range(2, longest + 1):
        rows = phrases[m]
        if m < longest:
            above = phrases[m + 1]
            parts = above.select(F.col("x").alias("_in"), "f").union(above.select("y", "f"))
            inside = parts.groupBy("_in").agg(F.max("f").alias("_f"))
            rows = rows.join(inside, rows["id"] == F.col("_in"), "left").where(F.coalesce(100 * F.col("_f"), F.lit(0)) < percent * F.col("f"))
        rows = rows.select("lang", F.col("words").alias("phrase"), F.col("f").alias("a"), "pre", "suf")
        out = rows if out is None else out.union(rows)
    out = out.join(words.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
    # of both parts' counts a quotient of exact decimals; suf is read from its end
    score = "(cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0))) div (cast(pre[k - 1] as decimal(19,0)) * cast(element_at(suf, -k) as decimal(18,0)))"
    cuts = f"transform(sequence(1, size(pre)), k -> named_struct('score', {score}, 'k', k, 'l', pre[k - 1], 'r', element_at(suf, -k)))"
    scored = out.withColumn("c", F.array_min(F.expr(cuts))).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.decode(F.unhex("lang"), "UTF-8").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def frequent(docs: DataFrame, least: int, longest: int, text_col: str = "text", lang_col: str = "lang", sizes: Sizes = Sizes()) -> tuple[dict[int, DataFrame], DataFrame]:
    """Stored tables of the phrases of m = 1 .. ``longest`` words that occur
    ``least`` times: (id, lang (in hex), words, last, f, x, y, pre, suf), x and y the
    ids of the phrase without its last and without its first word, pre and
    suf the counts of its beginnings and ends of 1 .. m - 1 words; and the
    number of words (lang, n)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    # in hex a language holds no line break, which separates it from words
    lang = F.hex(F.encode(F.coalesce(F.col(lang_col), F.lit("und")), "UTF-8"))
    rows = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = min(width, sizes.lists)
    cut = stored(rows.mapInArrow(_blocks(longest - 1, lists, sizes), _CUT), "blocks")
    spoken = cut.where("langs IS NOT NULL")
    words = stored(spoken.select(F.explode(F.arrays_zip("langs", "totals")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.totals").alias("n")), "languages")
    listed = cut.where("langs IS NULL").select("tile", "block", "words", "codes", "times")
    counted = listed.drop("block", "codes").repartition(width, "tile").sortWithinPartitions("tile").mapInArrow(_word_sums(least), "tile int, lang string, word string, f long")
    known = stored(numbered(stored(counted, "frequent"), [F.col("f").desc(), F.col("lang"), F.col("word")], "id"), "numbered-words")
    # a list's frequent words come first, then the blocks' words, one by one
    own = known.groupBy("tile").agg(F.collect_list(F.struct(F.concat("lang", F.lit("\n"), "word").alias("word"), "id")).alias("own"))
    own = own.select("tile", F.lit(-1).cast("long").alias("block"), F.col("own.word").alias("known"), F.col("own.id").alias("ids"))
    both = listed.drop("times").unionByName(own, allowMissingColumns=True).repartition(width, "tile").sortWithinPartitions("tile", "block")
    streams = _rewritten(spoken.select("block", "skip", "codes"), both.mapInArrow(_words_met, "block long, keys binary, ids binary"), _encoded)
    none = F.array().cast("array<long>")
    out = {1: stored(known.select("id", "lang", F.col("word").alias("words"), F.col("word").alias("last"), "f", F.lit(None).cast("long").alias("x"), F.lit(None).cast("long").alias("y"), none.alias("pre"), none.alias("suf")), "phrases-1")}
    for m in range(2, longest + 1):
        pairs, ids = out[m - 1], out[m - 1].count()
        if ids >= 3 << 30:
            raise ValueError("more phrases than pairs of their numbers fit a long")
        total = streams.agg(F.sum("places")).first()[0] or 0
        buckets = max(width, -(-total // sizes.bucket))
        tiles = streams.mapInArrow(_tiles(m, ids, buckets, sizes), "tile long, salt int, block long, keys binary, times binary")
        found = numbered(stored(_counted(tiles, ids, least, sizes), "pairs"), [F.col("f").desc(), F.col("x"), F.col("y")], "id")
        a = pairs.select(F.col("id").alias("_a"), "lang", F.col("words").alias("_words"), F.col("pre").alias("_pre"), F.col("f").alias("_fa"))
        b = pairs.select(F.col("id").alias("_b"), "last", F.col("suf").alias("_suf"), F.col("f").alias("_fb"))
        whole = found.join(a, F.col("x") == F.col("_a")).join(b, F.col("y") == F.col("_b"))
        out[m] = stored(whole.select("id", "lang", F.concat_ws(" ", "_words", "last").alias("words"), "last", "f", "x", "y", F.concat("_pre", F.array("_fa")).alias("pre"), F.concat("_suf", F.array("_fb")).alias("suf")), f"phrases-{m}")
        if m < longest:
            streams = _rewritten(streams.select("block", "skip", "codes"), _met(tiles, out[m], ids, buckets, sizes), _paired(ids))
    return out, words


def _counted(tiles: DataFrame, ids: int, least: int, sizes: Sizes) -> DataFrame:
    """(x, y, f) of the pairs with ``least`` occurrences."""
    width = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = tiles.select("tile", "salt", "keys", "times").repartition(width, "tile", "salt").sortWithinPartitions("tile")
    some = rows.mapInArrow(_summed(None, sizes), "tile long, keys binary, times binary").repartition(width, "tile").sortWithinPartitions("tile")
    pairs = some.mapInArrow(_summed(least, sizes), "tile long, keys binary, times binary")
    return pairs.mapInArrow(_spelled(ids, sizes), "x long, y long, f long")


def _met(tiles: DataFrame, found: DataFrame, ids: int, buckets: int, sizes: Sizes) -> DataFrame:
    """(block, keys, ids) of the frequent pairs ``found`` that each block has,
    a row a tile: met by tile, the dense tiles in parts."""
    numbers = found.select("x", "y", "id").mapInArrow(_by_tile(ids, buckets, sizes), "tile long, key long, id long")
    salts = F.when(F.col("tile") < sizes.dense, sizes.salts).otherwise(1)
    lists = numbers.groupBy("tile").agg(F.collect_list(F.struct("key", "id")).alias("found"))
    lists = lists.select("tile", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(-1).cast("long").alias("block"), F.col("found.key").alias("known"), F.col("found.id").alias("ids"))
    rows = tiles.select("tile", "salt", "block", "keys")
    width = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a tile's list comes first, then its blocks, one by one
    merged = rows.unionByName(lists, allowMissingColumns=True).repartition(width, "tile", "salt").sortWithinPartitions("tile", "salt", "block")
    return merged.mapInArrow(_matched(ids, sizes), "block long, keys binary, ids binary")


def _rewritten(blocks: DataFrame, found: DataFrame, rewrite) -> DataFrame:
    """Blocks (block, skip, codes) with new codes, by ``found`` (what a block's
    codes become); ``places``: how many codes are numbers."""
    own = lambda df: df.withColumnRenamed("block", "_block")
    both = own(found).groupBy("_block").cogroup(own(blocks).groupBy("_block"))
    return stored(both.applyInArrow(rewrite, "block long, skip int, codes binary, places long"), "streams")


#: Types that numbers are packed as, the smallest that holds them all.
_TYPES = (np.uint8, np.uint16, np.uint32, np.int64)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers from -1 on, compressed: how many, their type, and they
    themselves, one higher, all first bytes, then all second bytes, ..."""
    x = x.astype(np.int64) + 1
    kind = next(i for i, t in enumerate(_TYPES) if i == 3 or x.max(initial=0) <= np.iinfo(t).max)
    planes = x.astype(_TYPES[kind]).view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b""
    return len(x).to_bytes(8, "little") + bytes([kind]) + (pa.compress(planes, codec="zstd", asbytes=True) if len(x) else b"")


def _unpacked(data: bytes) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(_TYPES[data[8]])
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data[9:], n * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(-1, n).T).view(kind).ravel().astype(np.int64) - 1


def _steps(x: np.ndarray) -> bytes:
    """Rising numbers, packed by their differences."""
    return _packed(np.diff(x, prepend=0))


def _stepped(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


class _Codes(dict):
    """Numbers of the words of one language in a block."""

    def __init__(self, lang: str, words: list[bytes], langs: list[str]):
        self.lang, self.words, self.langs = lang, words, langs
        self[_END] = -1

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return code


class _Block:
    def __init__(self, number: int):
        self.number = number
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.languages: dict[str, _Codes] = {}
        self.codes: list[np.ndarray] = []
        self.skip = self.filled = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        codes = self.languages.get(lang)
        if codes is None:
            codes = self.languages[lang] = _Codes(lang, self.words, self.langs)
        self.codes.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
        self.filled += len(words)

    def rows(self, lists: int) -> Iterator[pa.RecordBatch]:
        codes = np.concatenate(self.codes)
        own = codes[self.skip :]
        times = np.bincount(own[own >= 0], minlength=len(self.words))
        langs = sorted(self.languages)
        of = {lang: i for i, lang in enumerate(langs)}
        lang = np.fromiter((of[x] for x in self.langs), np.int64, len(self.langs))
        totals = np.bincount(lang, weights=times, minlength=len(langs)).astype(np.int64)
        one = {"block": [self.number], "skip": [self.skip], "codes": [_packed(codes)], "langs": [langs], "totals": [totals]}
        yield _cut_batch(one, 1)
        # words by list, and by language and spelling in it
        tile = np.fromiter((zlib.crc32(w) for w in self.words), np.int64, len(self.words)) % lists
        spelled = [x.encode() + b"\n" + w for x, w in zip(self.langs, self.words)]
        order = np.array(sorted(range(len(spelled)), key=lambda i: (tile[i], spelled[i])), np.int64)
        firsts = np.flatnonzero(np.diff(tile[order], prepend=-1))
        ends = np.append(firsts[1:], len(order))
        for a in range(0, len(firsts), 2000):
            some = [order[i:j] for i, j in zip(firsts[a : a + 2000], ends[a : a + 2000])]
            yield _cut_batch(
                {
                    "block": [self.number] * len(some),
                    "tile": [int(tile[o[0]]) for o in some],
                    "words": [_text(b"\n".join(spelled[i] for i in o)) for o in some],
                    "codes": [_packed(o) for o in some],
                    "times": [_packed(times[o]) for o in some],
                },
                len(some),
            )


_CUT = "block long, skip int, codes binary, langs array<string>, totals array<long>, tile int, words binary, times binary"
_CUT_TYPES = {"block": pa.int64(), "skip": pa.int32(), "codes": pa.binary(), "langs": pa.list_(pa.string()), "totals": pa.list_(pa.int64()), "tile": pa.int32(), "words": pa.binary(), "times": pa.binary()}


def _cut_batch(columns: dict[str, list], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _CUT_TYPES.items()], names=list(_CUT_TYPES))


def _text(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _words_of(data: bytes) -> list[bytes]:
    """Language, word, language, word, ... (neither holds a line break)."""
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True).split(b"\n")


def _word_sums(least: int):
    """Frequent words of lists that come one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, {}

        def frequent() -> Iterator[pa.RecordBatch]:
            some = [(k, n) for k, n in sums.items() if n >= least]
            if some:
                langs, words = zip(*(k for k, _ in some))
                yield pa.RecordBatch.from_arrays([pa.array([now] * len(some), pa.int32()), _strings(langs), _strings(words), pa.array([n for _, n in some], pa.int64())], names=["tile", "lang", "word", "f"])

        for batch in batches:
            for tile, words, times in zip(*(batch.column(c).to_pylist() for c in ("tile", "words", "times"))):
                if tile != now:
                    yield from frequent()
                    now, sums = tile, {}
                found = _words_of(words)
                for k, n in zip(zip(found[::2], found[1::2]), _unpacked(times).tolist()):
                    sums[k] = sums.get(k, 0) + n
        yield from frequent()

    return run


def _strings(values) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _words_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, keys, ids): the codes of a block's frequent words, their numbers."""
    now, known = None, {}
    for batch in batches:
        names = ("tile", "block", "words", "codes")
        for i, (tile, block, words, codes) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
            if block < 0:
                now = tile
                known = dict(zip(batch.column("known")[i].as_py(), batch.column("ids")[i].as_py()))
                known = {tuple(k.encode().split(b"\n", 1)): n for k, n in known.items()}
            elif tile == now:
                found = _words_of(words)
                ids = np.fromiter(map(known.get, zip(found[::2], found[1::2]), repeat(-1)), np.int64, len(found) // 2)
                some = ids >= 0
                if some.any():
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_packed(_unpacked(codes)[some])], pa.binary()), pa.array([_packed(ids[some])], pa.binary())], names=["block", "keys", "ids"])


def _segments(text: str, most: int) -> Iterator[list[bytes]]:
    """The words of a text and the ends of its pieces, in parts."""
    data = text.encode().translate(_TABLE)
    at = 0
    while at < len(data):
        upto = len(data)
        if upto - at > most:  # up to the last gap or end before, else the next
            upto = max(data.rfind(b" ", at, at + most), data.rfind(_END, at, at + most))
            if upto <= at:
                upto = min((p for p in (data.find(b" ", at + 1), data.find(_END, at + 1)) if p > 0), default=len(data))
        yield data[at:upto].replace(_END, b" \xff ").split()  # only spaces are left
        at = upto


def _blocks(context: int, lists: int, sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block, last = _Block(number), []
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                last = []
                block.add(lang, [_END])
                for words in _segments(text, sizes.segment):
                    at = 0
                    while at < len(words):
                        some = words[at : at + max(1, sizes.block - block.filled)]
                        block.add(lang, some)
                        at += len(some)
                        last = (last + some[-context:])[-context:] if context else []
                        if block.filled >= sizes.block:
                            yield from block.rows(lists)
                            number += 1
                            block = _Block(number)
                            block.add(lang, [_END, *last])
                            block.skip = 1 + len(last)
        if block.filled > block.skip:
            yield from block.rows(lists)

    return run


def _encoded(found: pa.Table, blocks: pa.Table) -> pa.Table:
    """Codes of a block's words into their numbers, -1 for all others."""
    codes = _unpacked(blocks.column("codes")[0].as_py())
    numbers = np.full(int(codes.max(initial=-1)) + 2, -1, np.int64)  # the last stands for code -1
    for key, ids in zip(found.column("keys").to_pylist(), found.column("ids").to_pylist()):
        numbers[_unpacked(key)] = _unpacked(ids)
    return _stream(blocks, numbers[codes])


def _paired(ids: int):
    def run(found: pa.Table, blocks: pa.Table) -> pa.Table:
        """Every pair of adjacent numbers into its own number, -1 if it has none."""
        s = _unpacked(blocks.column("codes")[0].as_py())
        x, y = s[:-1], s[1:]
        out = np.full(len(x), -1, np.int64)
        if found.num_rows:
            key = np.concatenate([_stepped(k) for k in found.column("keys").to_pylist()])
            numbers = np.concatenate([_unpacked(k) for k in found.column("ids").to_pylist()])
            order = np.argsort(key)
            key, numbers = key[order], numbers[order]
            at = np.flatnonzero((x >= 0) & (y >= 0))
            want = x[at] * ids + y[at]
            place = np.minimum(np.searchsorted(key, want), len(key) - 1)
            hit = key[place] == want
            out[at[hit]] = numbers[place[hit]]
        return _stream(blocks, out)

    return run


def _stream(blocks: pa.Table, s: np.ndarray) -> pa.Table:
    return pa.table({"block": blocks.column("_block"), "skip": blocks.column("skip"), "codes": pa.array([_packed(s)], pa.binary()), "places": pa.array([int((s >= 0).sum())], pa.int64())})


def _tile_of(x: np.ndarray, y: np.ndarray, buckets: int, sizes: Sizes) -> np.ndarray:
    """Dense tiles by their place, sparse ones by the bucket they share."""
    x, y = x // sizes.tile, y // sizes.tile
    mixed = (x * 0x9E3779B1 + y * 0x85EBCA77) & 0x7FFFFFFFFFFF
    return np.where((x < sizes.side) & (y < sizes.side), x * sizes.side + y, sizes.dense + (mixed ^ mixed >> 17) % buckets)


def _tiles(m: int, ids: int, buckets: int, sizes: Sizes):
    """A block's pairs of adjacent numbers, counted, by tile: cells of dense
    tiles as int32, pairs of the others as x * ids + y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, skip, codes in zip(*(batch.column(c).to_pylist() for c in ("block", "skip", "codes"))):
                s = _unpacked(codes)
                at = np.flatnonzero((s[:-1] >= 0) & (s[1:] >= 0))
                key, of = np.unique(s[at] * ids + s[at + 1], return_inverse=True)
                # pairs that end before this block's own words don't count, but longer phrases have them
                times = np.bincount(of[np.searchsorted(at, skip - m + 1) :], minlength=len(key))
                if not len(key):
                    continue
                x, y = key // ids, key % ids
                tile = _tile_of(x, y, buckets, sizes)
                order = np.argsort(tile, kind="stable")
                tile, key, times = tile[order], key[order], times[order].astype(np.int64)
                cell = (x % sizes.tile * sizes.tile + y % sizes.tile)[order]
                firsts = np.flatnonzero(np.diff(tile, prepend=-1))
                ends = np.append(firsts[1:], len(tile))
                names = tile[firsts]
                keys = [_steps(cell[a:b] if t < sizes.dense else key[a:b]) for t, a, b in zip(names, firsts, ends)]
                counts = [_packed(times[a:b]) for a, b in zip(firsts, ends)]
                salt = np.where(names < sizes.dense, block % sizes.salts, 0).astype(np.int32)
                for a in range(0, len(names), 5000):
                    b = a + 5000
                    yield pa.RecordBatch.from_arrays([pa.array(names[a:b]), pa.array(salt[a:b]), pa.array(np.full(len(names[a:b]), block)), pa.array(keys[a:b], pa.binary()), pa.array(counts[a:b], pa.binary())], names=["tile", "salt", "block", "keys", "times"])

    return run


class _Tile:
    """The sum of one tile's rows: a dense array, or sorted coordinates that
    are merged whenever as many new ones have come."""

    def __init__(self, number: int, sizes: Sizes):
        self.number, self.dense = number, number < sizes.dense
        self.sums = np.zeros(sizes.tile**2 if self.dense else 0, np.int64)
        self.keys = np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: bytes, times: np.ndarray) -> None:
        key = _stepped(keys)
        self.new.append((key, times))
        self.waiting += len(key)
        if self.waiting > max(1 << 20, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        if not self.new:
            return
        key, times = (np.concatenate(c) for c in zip(*self.new))
        if self.dense:
            got = np.bincount(key, weights=times, minlength=len(self.sums))  # exact: below 2^53
            self.sums += got.astype(np.int64)
        else:
            self.keys, at = np.unique(np.concatenate([self.keys, key]), return_inverse=True)
            sums = np.zeros(len(self.keys), np.int64)
            np.add.at(sums, at, np.concatenate([self.sums, times]))
            self.sums = sums
        self.new, self.waiting = [], 0

    def row(self, least: int | None) -> tuple[int, bytes, bytes] | None:
        self.merge()
        some = np.flatnonzero(self.sums >= (least or 1))
        return (self.number, _steps(some if self.dense else self.keys[some]), _packed(self.sums[some])) if len(some) else None


def _summed(least: int | None, sizes: Sizes):
    """Sums of rows that come tile by tile; ``least``: those of so much only."""

    def batch_of(rows: list) -> pa.RecordBatch:
        tile, keys, times = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(tile, pa.int64()), pa.array(keys, pa.binary()), pa.array(times, pa.binary())], names=["tile", "keys", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Tile | None = None
        for batch in batches:
            for number, keys, times in zip(*(batch.column(c).to_pylist() for c in ("tile", "keys", "times"))):
                if now is None or now.number != number:
                    if now is not None and (row := now.row(least)):
                        yield batch_of([row])
                    now = _Tile(number, sizes)
                now.add(keys, _unpacked(times))
        if now is not None and (row := now.row(least)):
            yield batch_of([row])

    return run


def _pairs(tile: int, keys: bytes, ids: int, sizes: Sizes) -> np.ndarray:
    """A tile's pairs as x * ids + y."""
    if tile >= sizes.dense:
        return _stepped(keys)
    cell = _stepped(keys)
    return (tile // sizes.side * sizes.tile + cell // sizes.tile) * ids + tile % sizes.side * sizes.tile + cell % sizes.tile


def _spelled(ids: int, sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, keys, times in zip(*(batch.column(c).to_pylist() for c in ("tile", "keys", "times"))):
                key = _pairs(tile, keys, ids, sizes)
                yield pa.RecordBatch.from_arrays([pa.array(key // ids), pa.array(key % ids), pa.array(_unpacked(times))], names=["x", "y", "f"])

    return run


def _by_tile(ids: int, buckets: int, sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.asarray(batch.column(c)) for c in ("x", "y"))
            yield pa.RecordBatch.from_arrays([pa.array(_tile_of(x, y, buckets, sizes)), pa.array(x * ids + y), batch.column("id")], names=["tile", "key", "id"])

    return run


def _matched(ids: int, sizes: Sizes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, number = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            known, numbers = batch.column("known"), batch.column("ids")
            for i, (tile, block, keys) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("tile", "block", "keys")))):
                if block < 0:
                    now, key, number = tile, np.asarray(known[i].values), np.asarray(numbers[i].values)
                    order = np.argsort(key)
                    key, number = key[order], number[order]
                elif tile == now:
                    want = _pairs(tile, keys, ids, sizes)
                    place = np.minimum(np.searchsorted(key, want), len(key) - 1)
                    hit = key[place] == want
                    if hit.any():
                        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_steps(want[hit])], pa.binary()), pa.array([_packed(number[place[hit]])], pa.binary())], names=["block", "keys", "ids"])

    return run
