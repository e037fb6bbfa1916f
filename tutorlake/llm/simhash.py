"""SimHash near-duplicates, found through Golay-code keys.

The binary Golay code of length 23 corrects three errors and is perfect: every 23-bit word lies within
3 bits of exactly one code word. Decoding all words within one bit of a segment gives at most a few code
words, and two segments that differ in at most two bits share one of them, since a word between the two
lies within one bit of both.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in two bits or fewer agree
wholly in one segment and differ in at most two bits in the next, so they share a key made of the one
segment as it is and of a code word of the next. Fingerprints sharing a key are verified bit by bit.
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
from tutorlake.sources.tables import settle

SHINGLE = 3
SEED = 42
DISTANCE = 2
BUCKET = 48
# First bit and length of the three segments; generator polynomial of the Golay code.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xAE3


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of the word shingles of a text, repeats included.

    ASCII capitals count as small letters. A text of fewer words has its whole word sequence as its only
    shingle; a null or blank text has fingerprint 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    ones = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """All columns but the text, and the fingerprint as a signed 64-bit number in ``name``."""
    others = [c for c in documents.columns if c not in (text, name)]
    schema = T.StructType([*(documents.schema[c] for c in others), T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(x.as_py()) for x in batch.column(len(others))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(marks.view(np.int64))], names=[*others, name]
            )

    return documents.select(*others, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


def code_words() -> np.ndarray:
    """The number of the code word within 3 bits, for each of the 2**23 words; 16 MB, built by rule."""
    places = np.arange(4096, dtype=np.uint32)
    words = np.zeros(4096, np.uint32)
    for bit in range(12):
        words ^= np.where(places >> bit & 1, np.uint32(GENERATOR << bit), np.uint32(0)).astype(np.uint32)
    one = np.uint32(1) << np.arange(23, dtype=np.uint32)
    two = (one[:, None] ^ one).ravel()
    errors = np.unique((two[:, None] ^ one).ravel())
    errors = np.unique(np.concatenate([errors, two]))
    table = np.zeros(1 << 23, np.uint16)
    for error in errors:
        table[words ^ error] = places
    return table


def golay_keys(marks: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(which, key)``: for fingerprint number ``which``, all its keys, each once; ``table`` as above."""
    which, keys = [], []
    for turn, (start, width) in enumerate(SEGMENTS):
        exact = marks >> np.uint64(start) & np.uint64((1 << width) - 1)
        near_start, near_width = SEGMENTS[(turn + 1) % len(SEGMENTS)]
        near = (marks >> np.uint64(near_start) & np.uint64((1 << near_width) - 1)).astype(np.uint32)
        flips = np.concatenate([[0], 1 << np.arange(near_width)]).astype(np.uint32)
        codes = np.sort(table[near[:, None] ^ flips], axis=1)
        fresh = np.ones(codes.shape, bool)
        fresh[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, column = np.nonzero(fresh)
        which.append(row)
        keys.append(exact[row] << np.uint64(14) | codes[row, column].astype(np.uint64) << np.uint64(2) | np.uint64(turn))
    return np.concatenate(which), np.concatenate(keys)


def close_pairs(marks: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs among a few fingerprints that differ in at most ``distance`` bits."""
    apart = np.bitwise_count(marks[:, None] ^ marks)
    left, right = np.nonzero(apart <= distance)
    return left[left < right], right[left < right]


def links(marks: DataFrame, name: str = "fp") -> DataFrame:
    """``(left, right)``: links of distinct fingerprints that join all pairs within two bits.

    Pairs in small buckets are verified one by one. Fingerprints of a bucket of more than ``BUCKET``
    get an exact other way, without pairs: each is listed under all words within one bit, and those under
    one word, at most 65, are within two bits of each other, so a chain through them is enough.
    """
    distinct = marks.select(F.col(name).alias("fp")).distinct()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = code_words()
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 20_000):
                part = values[at : at + 20_000]
                which, keys = golay_keys(part.view(np.uint64), table)
                yield pa.RecordBatch.from_arrays([keys.view(np.int64), part[which]], names=["key", "fp"])

    keys = settle(distinct.mapInArrow(keyed, "key long, fp long"), "golay")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = keys.join(sizes, "key")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(0)
            values, offsets = groups.values.to_numpy().view(np.uint64), groups.offsets.to_numpy()
            found = [np.zeros((0, 2), np.uint64)]
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                left, right = close_pairs(values[a:b])
                found.append(np.stack([values[a:b][left], values[a:b][right]], axis=1))
            pairs = np.unique(np.concatenate(found), axis=0).view(np.int64)
            yield pa.RecordBatch.from_arrays([pairs[:, 0].copy(), pairs[:, 1].copy()], names=["left", "right"])

    small = (
        met.where(F.col("size") <= BUCKET)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
        .mapInArrow(verified, "left long, right long")
    )

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 5_000):
                part = values[at : at + 5_000]
                words = (part.view(np.uint64)[:, None] ^ flips).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([words, np.repeat(part, 65)], names=["word", "fp"])

    def chained(fps: F.Column) -> F.Column:
        return F.zip_with(fps, F.slice(fps, F.lit(2), F.size(fps)), lambda a, b: F.struct(a.alias("left"), b.alias("right")))

    large = (
        met.where(F.col("size") > BUCKET)
        .select("fp")
        .distinct()
        .mapInArrow(around, "word long, fp long")
        .groupBy("word")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.inline(F.transform(F.array("fps"), chained)[0]))
        .where(F.col("right").isNotNull())
    )
    return small.union(large).distinct()


def classes(marks: DataFrame, key: str = "doc_id", name: str = "fp") -> DataFrame:
    """All rows with ``component_id``: the smallest key among the rows reachable over links.

    Equal fingerprints, that of blank texts too, are one node whatever the number of rows; a null key
    takes part but is never the smallest. Repeated rows stay.
    """
    roots = components(links(marks, name), "left", "right")
    least = marks.groupBy(name).agg(F.min(key).alias("least"))
    rooted = least.join(roots, F.col(name) == F.col("node"), "left").select(
        name, "least", F.coalesce("root", name).alias("root")
    )
    grouped = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_mark = rooted.join(grouped, "root").select(F.col(name).alias("__fp"), "component_id")
    return marks.join(by_mark, F.col(name) == F.col("__fp")).drop("__fp")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp, component_id)`` for every document."""
    return classes(settle(fingerprints(documents.select(key, text), text), "fingerprints"), key)


def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(documents).select("doc_id", digits.alias("fingerprint"), "component_id")
