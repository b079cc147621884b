"""A corpus for training, from documents to packed sequences.

Five stages, each one operator of cirrus.llm over all that its predecessor
kept.  Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of ``documents`` (doc_id, text, lang, source,
n_chars).  Null and empty texts fail the quality rules; null ids, ties and
repeated rows are handled as each operator states; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.llm import mixing, neardup, packing, quality, secretscan
from cirrus.llm.common import columns_of, stored
from cirrus.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and the isolation forest keep."""
    return quality.passing(docs.select(*COLUMNS), columns_of(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group."""
    return neardup.deduplicated(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced; n_chars follows."""
    out = secretscan.redacted(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by target weights: a row for each copy of a document that it
    takes, cut where the mix takes a part; n_chars follows."""
    out = mixing.mixed_texts(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return packing.pack(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("secret scan", redact_secrets),
    ("source mix", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The forest, MinHash, network and tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns_of(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
