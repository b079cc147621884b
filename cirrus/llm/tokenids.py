"""Token ids as flat binary files that can be memory-mapped.

A data set is a folder of shards.  A shard holds the documents of one range
of ids, in ascending order, in three files without any header:

* ``<shard>.ids``: the token ids of all its documents one after the other,
  little-endian unsigned integers of 2 bytes where the vocabulary allows it,
  else 4;
* ``<shard>.offsets``: little-endian 64-bit integers, the place of every
  document's first id in the shard and, last, the number of ids;
* ``<shard>.docs``: little-endian 64-bit document ids.

``manifest`` (Parquet) has one row per shard: its files, their sizes, and the
numbers of documents and of ids in all shards before it.  These bases are
prefix sums over the shards, so a shard is written without knowing the others,
and document number d of the shard starts at ``start + offsets[d]`` of the
whole corpus.

Shards are written by tasks straight to the folder, under names of their own;
the manifest lists those of the tasks that Spark counts as done, so that a
task run twice (a lost executor, speculation) leaves files that nobody reads.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cirrus.llm.common import bounded_batches
from cirrus.llm.packing import remembered

#: Bytes of text, and documents, that a shard is planned for.
SHARD_BYTES, SHARD_DOCS = 64 << 20, 1 << 22
#: A size from which on Spark means that it doesn't know one.
UNKNOWN = 1 << 50
#: Documents that a reading task takes at a time.
READ_DOCS = 1 << 16

_SHARD = "shard int, file string, width int, docs long, nulls long, ids long"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write(docs: DataFrame, tokenizer: str, end_id: int, path: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the ids of every row of ``docs``, each followed by ``end_id``,
    into the folder ``path`` (a local, mounted or otherwise shared one that
    pyarrow can write to) and returns the manifest.

    Documents are in ascending order of id, rows without id first; rows of
    one id are in an order of their texts' hashes.  Null and empty texts are
    ``end_id`` alone.  Other columns are ignored.  An empty table has a
    manifest without shards.  A row's text is tokenised whole, in one task;
    an id or text that very many rows share is spread over shards by the
    rows' hash and, where that ties, by chance, which changes no file's
    content.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    shards = max(1, -(-text_bytes(rows) // shard_bytes), -(-size // SHARD_DOCS))
    tie = F.xxhash64("text")
    # equal rows would fall in one range: a number that takes part in no order tells them apart
    dealt = rows.withColumn("tie", tie).withColumn("spread", F.rand(17)).repartitionByRange(shards, "id", "tie", "spread")
    done = dealt.sortWithinPartitions("id", "tie").select("id", "text").mapInArrow(_writer(tokenizer, end_id, path), _SHARD)
    listed = path.rstrip("/") + "/shards"
    done.write.parquet(listed)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    manifest = spark.read.schema(_SHARD).parquet(listed).where("docs > 0").withColumn("first", earlier("docs")).withColumn("start", earlier("ids"))
    manifest.coalesce(1).write.parquet(path.rstrip("/") + "/manifest")
    return opened(spark, path)


def text_bytes(rows: DataFrame) -> int:
    """About how many bytes of text ``rows`` (id, text) have: for files twice
    their size, as texts are compressed there; else counted."""
    known = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < UNKNOWN:
        return 2 * known
    return rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0


def opened(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a data set that :func:`write` made."""
    return spark.read.schema(f"{_SHARD}, first long, start long").parquet(path.rstrip("/") + "/manifest")


def read(manifest: DataFrame, path: str) -> DataFrame:
    """Per document, from the files: (doc_id, start, n_tokens, ids_crc32);
    the checksum is over the ids as little-endian unsigned 32-bit integers."""
    step = F.lit(READ_DOCS).cast("long")
    runs = manifest.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, step)))
    width = max(1, manifest.agg(F.sum(F.ceil(F.col("docs") / READ_DOCS))).first()[0] or 0)
    runs = runs.select("file", "width", "docs", "nulls", "ids", "start", "from").repartition(int(min(width, 1 << 16)))
    return runs.mapInArrow(_reader(path), _READ)


class Shard:
    """One shard's files; memory-mapped where the folder is a local or mounted
    one, else read by ranges."""

    def __init__(self, path: str, file: str, width: int, docs: int, ids: int):
        self.at, self.file = _filesystem(path), file
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        self.docs, self.n_ids = docs, ids

    def _values(self, kind: str, dtype: np.dtype, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, dtype)
        files, folder = self.at
        name = f"{folder}/{self.file}.{kind}"
        if isinstance(files, pafs.LocalFileSystem):
            return np.memmap(name, dtype, "r")[a:b]
        with files.open_input_file(name) as f:
            return np.frombuffer(f.read_at((b - a) * dtype.itemsize, a * dtype.itemsize), dtype)

    def offsets(self, a: int, b: int) -> np.ndarray:
        """Of the documents a .. b - 1, and where the last of them ends."""
        return self._values("offsets", np.dtype("<i8"), a, b + 1)

    def doc_ids(self, a: int, b: int) -> np.ndarray:
        return self._values("docs", np.dtype("<i8"), a, b)

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids in the places a .. b - 1 of the shard."""
        return self._values("ids", self.dtype, a, b)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):  # with one, two or three slashes
        path = "/" + path.removeprefix("file:").lstrip("/")
    files, folder = pafs.FileSystem.from_uri(path)
    return files, folder.rstrip("/")


def _writer(tokenizer: str, end_id: int, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = remembered(tokenizer)
        width = 2 if max(known.bpe.highest, end_id) < 1 << 16 else 4
        dtype = np.dtype("<u2" if width == 2 else "<u4")
        end = array("I", [end_id]).tobytes()
        files, folder = _filesystem(path)
        files.create_dir(folder, recursive=True)
        shard = TaskContext.get().partitionId()
        file = f"{shard:07d}-{uuid.uuid4().hex[:12]}"
        docs = nulls = ids = 0
        open_file = lambda kind: files.open_output_stream(f"{folder}/{file}.{kind}")
        with open_file("ids") as flat, open_file("offsets") as offsets, open_file("docs") as numbers:
            for batch in batches:
                found = [known.of(text or "") + end for text in batch.column(1).to_pylist()]
                n = np.fromiter(map(len, found), np.int64, len(found)) // 4
                flat.write(np.frombuffer(b"".join(found), np.uint32).astype(dtype).tobytes())
                offsets.write((ids + np.cumsum(n) - n).astype("<i8").tobytes())
                numbers.write(np.asarray(batch.column(0).fill_null(0)).astype("<i8").tobytes())
                docs, nulls, ids = docs + len(found), nulls + batch.column(0).null_count, ids + int(n.sum())
            offsets.write(np.array([ids], "<i8").tobytes())
        one = lambda v, t: pa.array([v], t)
        yield pa.RecordBatch.from_arrays(
            [one(shard, pa.int32()), one(file, pa.string()), one(width, pa.int32()), one(docs, pa.int64()), one(nulls, pa.int64()), one(ids, pa.int64())],
            names=["shard", "file", "width", "docs", "nulls", "ids"],
        )

    return run


def _reader(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(path, r["file"], r["width"], r["docs"], r["ids"])
                a, b = r["from"], min(r["docs"], r["from"] + READ_DOCS)
                at = shard.offsets(a, b)
                numbers = pa.array(shard.doc_ids(a, b), mask=np.arange(a, b) < r["nulls"])
                crc = np.zeros(b - a, np.int64)
                base, i = 0, 0
                while i < b - a:  # some documents' ids at a time
                    upto = max(i + 1, int(np.searchsorted(at, at[i] + (1 << 22), "right")) - 1)
                    base = int(at[i])
                    wide = memoryview(shard.ids(base, int(at[upto])).astype("<u4").tobytes())
                    for k in range(i, upto):
                        crc[k] = zlib.crc32(wide[4 * (int(at[k]) - base) : 4 * (int(at[k + 1]) - base)])
                    i = upto
                yield pa.RecordBatch.from_arrays([numbers, pa.array(r["start"] + at[:-1]), pa.array(np.diff(at)), pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run
