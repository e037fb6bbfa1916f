"""MinHash near-duplicates, found by a join over many small indexes of b-bit signatures.

A signature has 128 symbols of 16 bits, each the mixed minimum of one hash function over a document's set of
word shingles; two symbols agree with the probability of the sets' Jaccard similarity. The first 60 symbols are
cut into 12 chunks of five. Two signatures that differ in at most 23 of the 60 have a chunk with at most one
differing symbol, by the pigeonhole principle, so each chunk is listed under the five keys that leave out one
of its symbols, and every such pair shares a key. Pairs at a similarity of 0.8 share none with probability 1e-7.

Signatures of one key are compared as a whole; those that differ in more than ``APART`` of the 128 symbols, at 0.8
one pair in a million, are not candidates. Documents reachable over candidates form a cloud, and in a cloud
full sets are compared. Neither keys nor clouds are expanded into pairs, see :mod:`tutorlake.llm.groups`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.llm.components import components
from tutorlake.llm.groups import Near, confirmed, linked, sizes_fit
from tutorlake.llm.shingles import FACTORS, least_hashes, mixed, shingles
from tutorlake.sources.tables import settle

SHINGLE = 4
CHUNKS = 12
WIDTH = 5
APART = 48
# Members of a key that one tile holds.
TILE = 4096


def signatures(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(key, n, hi, lo, index, sketch)``: the set's size and 128 bits that name it, the first 60 symbols, all low bytes.

    A text without words has ``n`` 0 and nulls behind it.
    """
    kinds = [("n", T.LongType()), ("hi", T.LongType()), ("lo", T.LongType()), ("index", T.BinaryType()), ("sketch", T.BinaryType())]
    schema = T.StructType([documents.schema[key], *(T.StructField(*k) for k in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for body in batch.column(1):
                found = shingles(body.as_py(), shingle)
                if not len(found):
                    rows.append((0, None, None, None, None))
                    continue
                symbols = (mixed(least_hashes(found)) >> np.uint64(48)).astype("<u2")
                name = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8").tolist()
                rows.append((len(found), *name, symbols[: CHUNKS * WIDTH].tobytes(), symbols.astype(np.uint8).tobytes()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], k) for k in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return documents.select(key, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


def index_keys() -> F.Column:
    """The 60 keys of the column ``index``: each chunk without one of its symbols."""
    keys = []
    for chunk in range(CHUNKS):
        for out in range(WIDTH):
            at = 2 * WIDTH * chunk + 1
            left = F.expr(f"substring(index, {at}, {2 * out})")
            right = F.expr(f"substring(index, {at + 2 * out + 2}, {2 * (WIDTH - 1 - out)})")
            keys.append(F.xxhash64(F.lit(WIDTH * chunk + out), left, right))
    return F.array(*keys)


def sketches_near(sizes: np.ndarray, marks: list[bytes]) -> Near:
    rows = np.frombuffer(b"".join(marks), np.uint8).reshape(len(marks), len(FACTORS))

    def near(one: int, others: np.ndarray) -> np.ndarray:
        found = sizes_fit(sizes[one], sizes[others])
        fit = np.nonzero(found)[0]
        found[fit] = np.count_nonzero(rows[others[fit]] != rows[one], axis=1) <= APART
        return found

    return near


def candidates(nodes: DataFrame) -> DataFrame:
    """Links ``(left, right)`` between nodes ``(node, n, index, sketch)`` that share a key and whose signatures are close."""
    keys = nodes.select(F.explode(index_keys()).alias("group"), "node")
    sizes = keys.groupBy("group").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = keys.join(sizes, "group").join(nodes.select("node", "n", F.col("sketch").alias("mark")), "node")
    met = settle(met.select("group", "size", "node", "n", "mark"), "keys")
    return linked(met, sketches_near, TILE, not met.where(F.col("size") > TILE).isEmpty(), "near")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row: the smallest key reachable over links, itself included.

    A document's set holds its distinct word shingles, ASCII capitals counting as small letters; with fewer words
    the whole sequence is its only one. Null, empty and blank texts have no shingle and no link. Rows without a key are
    never linked and have no class. Rows of one key are told apart by their sets; equal sets are one node whatever
    the number of rows. Repeated rows stay, other columns play no part.
    """
    marks = settle(signatures(documents, key, text, shingle), "signatures")
    known = marks.where(F.col(key).isNotNull() & (F.col("n") > 0))
    nodes = settle(
        known.groupBy("hi", "lo").agg(F.min(key).alias("node"), *[F.first(c).alias(c) for c in ("n", "index", "sketch")]), "nodes"
    )
    links = confirmed(candidates(nodes), nodes, documents.where(F.col(key).isNotNull()), key, text, shingle)
    roots = components(links, "left", "right").toDF("__node", "root")
    rooted = nodes.join(roots, F.col("node") == F.col("__node"), "left").select(
        F.col("hi").alias("__hi"), F.col("lo").alias("__lo"), F.coalesce("root", "node").alias("root")
    )
    same = (F.col("hi") == F.col("__hi")) & (F.col("lo") == F.col("__lo"))
    return marks.join(rooted, same, "left").select(
        key, F.col("n").alias("n_shingles"), F.when(F.col(key).isNotNull(), F.coalesce("root", key)).alias("component_id")
    )


def op12_minhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, and whether it is the one of its class that stays."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(documents)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
