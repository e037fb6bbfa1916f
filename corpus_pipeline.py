"""Corpus cleaning in five stages, each over all rows that the stage before has kept.

Toxic documents go, one document of every group of near-duplicates stays, strings that stand elsewhere too
are cut out of the texts, documents that hold a benchmark item go, and what is left is packed into
training sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.llm import decontamination, near_copies, packing, suffix_dedup, toxicity
from tutorlake.session import fresh_dir
from tutorlake.sources.tables import drop_folder, stored_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Bytes that a passage of 50 words has at least, but for one in twenty.
PASSAGE = 250
# Bytes of rows that a task hands to its Python worker at once. The text of a whole split fits the 64 MB that Spark
# allows, and then each side holds copies of it.
HANDED = 4 << 20
_read_for_good: list[str] = []


def stage(work: Stage) -> Stage:
    """A stage that deletes the working tables of the stage before, whose result has been written by then.

    It leaves ``HANDED`` as a setting of the session, as its result is worked out after it has returned.
    """

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(HANDED))
        while _read_for_good:
            drop_folder(spark, _read_for_good.pop())
        with stored_paths() as paths:
            result = work(spark, docs, sf_dir)
        _read_for_good.extend(paths)
        return result

    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half by a model of the labelled documents among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every class of near copies: fingerprints within two bits, or five-word
    shingles of similarity 0.8 or more.
    """
    return near_copies.first_of_each(docs)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of ``PASSAGE`` bytes that start elsewhere too; ``n_chars`` follows."""
    cut = suffix_dedup.without_repeats(docs, length=PASSAGE)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even with a few edits."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_duplicates),
    ("suffix-dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
# Hashes of shingles, suffix arrays, nearest examples and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
