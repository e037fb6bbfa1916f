"""Near copies: documents whose SimHash fingerprints are within two bits, found through Golay keys as in
:mod:`tutorlake.llm.simhash`, or whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

At a similarity of 0.8 fingerprints differ in ten of 64 bits, out of reach of Golay keys, so candidates for the second kind
share a band, that is five of the least hashes of their sets; 25 bands find a pair of similarity
0.8 with probability 0.99995 and one of 0.9 with all but 1e-9. Documents reachable over candidates form a cloud, in
which whole sets are compared, so nothing goes that is not a near copy, directly or over others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.llm.components import components
from tutorlake.llm.groups import Near, confirmed, linked, sizes_fit, without
from tutorlake.llm.shingles import MIX, least_hashes, mixed, shingles
from tutorlake.llm.simhash import fingerprint, links
from tutorlake.sources.tables import settle

SHINGLE = 5
BANDS = 25
ROWS = 5
# Members of a band that one tile holds.
TILE = 4096
# Of the 128 bits of a sketch a pair at 0.8 differs in 12.8 on average, and in more than 32 once in some million pairs.
APART = 32


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for at in range(ROWS):
        keys = mixed(keys * MIX + rows[:, at])
    return keys


def signatures(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp, n, hi, lo, sketch, bands)``: the SimHash fingerprint, the set's size and 128 bits that name it, a
    sketch of 128 bits, the band keys.
    """
    schema = T.StructType(
        [
            documents.schema[key],
            *(T.StructField(c, T.LongType()) for c in ("fp", "n", "hi", "lo")),
            T.StructField("sketch", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, sketches, bands = np.zeros((len(batch), 4), np.int64), [], []
            for k, x in enumerate(batch.column(1)):
                body = x.as_py()
                marks[k, 0] = np.uint64(fingerprint(body)).view(np.int64)
                found = shingles(body, SHINGLE)
                if not len(found):
                    sketches.append(b"")
                    bands.append(np.zeros(0, np.int64))
                    continue
                least = least_hashes(found)
                marks[k, 1:] = len(found), *np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8")
                sketches.append(np.packbits((mixed(least) >> np.uint64(63)).astype(np.uint8)).tobytes())
                bands.append(band_keys(least).view(np.int64))
            columns = [pa.array(marks[:, c].copy()) for c in range(4)]
            columns += [pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return documents.select(key, F.col(text).cast("binary")).mapInArrow(run, schema)


def sketches_near(sizes: np.ndarray, marks: list[bytes]) -> Near:
    rows = np.frombuffer(b"".join(marks), "<u8").reshape(len(marks), 2)

    def near(one: int, others: np.ndarray) -> np.ndarray:
        apart = np.bitwise_count(rows[others] ^ rows[one]).sum(axis=1)
        return sizes_fit(sizes[one], sizes[others]) & (apart <= APART)

    return near


def by_sets(documents: DataFrame, nodes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Links ``(left, right)`` that join all ``nodes (node, n, sketch, bands)`` of similarity 0.8 or more."""
    keys = nodes.select("node", F.explode("bands").alias("group"))
    sizes = keys.groupBy("group").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = keys.join(sizes, "group").join(nodes.select("node", "n", F.col("sketch").alias("mark")), "node")
    met = settle(met.select("group", "size", "node", "n", "mark"), "bands")
    near = linked(met, sketches_near, TILE, not met.where(F.col("size") > TILE).isEmpty(), "near")
    return confirmed(near, nodes, documents, key, text, SHINGLE)


def by_shared(rows: DataFrame, name: str) -> DataFrame:
    """Links ``(left, right)`` that join all nodes of ``rows (name, node)`` with the same value of ``name``."""
    least = rows.groupBy(name).agg(F.min("node").alias("right"), F.max("node").alias("last")).where(F.col("right") < F.col("last"))
    return rows.join(least, name).select(F.col("node").alias("left"), "right")


def by_fingerprints(marks: DataFrame) -> DataFrame:
    """Links ``(left, right)`` that join all nodes of ``marks (fp, node)`` whose fingerprints are within two bits."""
    least = marks.groupBy("fp").agg(F.min("node").alias("least"))
    close = links(marks)
    for side in ("left", "right"):
        close = close.join(least.select(F.col("fp").alias(side), F.col("least").alias(f"{side}_node")), side)
    return by_shared(marks, "fp").union(close.select("left_node", "right_node"))


def later_copies(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The keys that have a near copy of smaller key, directly or over others, each once.

    Equal sets, those of blank texts too, are one node whatever the number of rows, named by the least key. Links of
    fingerprints, of sets and of the rows of one key make one graph, so classes that share a document are one.
    """
    marks = settle(signatures(documents, key, text), "signatures")
    least = marks.groupBy("hi", "lo").agg(F.min(F.struct(F.col(key).alias("node"), "n", "sketch", "bands")).alias("least"))
    nodes = settle(least.select("hi", "lo", "least.*"), "nodes")
    placed = marks.select(key, "fp", "hi", "lo").join(nodes.select("hi", "lo", "node"), ["hi", "lo"])
    placed = settle(placed.select(key, "fp", "node"), "placed")
    marked = settle(placed.select("fp", "node").distinct(), "marked")
    found = by_sets(documents, nodes, key, text).union(by_fingerprints(marked)).union(by_shared(placed.select(key, "node"), key))
    rooted = placed.select(key, "node").join(components(found, "left", "right"), "node", "left")
    return settle(rooted.where(F.col(key) != F.coalesce("root", "node")).select(key).distinct(), "later")


def first_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that have a near copy of smaller key, directly or over others.

    Rows of one key are one document and stay or go together; rows without a key stay.
    """
    return without(documents, later_copies(documents.where(F.col(key).isNotNull()), key, text), key)
