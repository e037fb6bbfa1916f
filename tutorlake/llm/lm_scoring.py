"""Language-model scores by a weighted backoff automaton over words.

The model is an interpolated word bigram over the smoothed unigrams. Written as an automaton, every word
that was seen in training, and the start of a text, is a state. A seen bigram is an arc with its smoothed
log-probability; every other word is reached by the failure arc to the root, at the price of the state's
backoff weight, and from there by its unigram. A text is scored in one traversal from left to right.

Bigrams of the whole corpus fit in no task. Texts are therefore put into chunks of about ``CHUNK_BYTES``.
A chunk asks for the counts of its own distinct words and bigrams, in sorted lists by ranges of their
hashes; a range adds up what all chunks sent and answers each in its own order. With the answers a chunk
builds the part of the automaton that its texts can reach. Lists are long where the corpus is small and
short where it is large, and there are never more of them than distinct bigrams in all chunks.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.session import fresh_dir
from tutorlake.sources.tables import settle

FOLDS = 10
ADD = 0.1
CHUNK_BYTES = 6_000_000
RANGE_BYTES = 12_000_000
CLASSES = 64
# Hashes of the end and the start of a text; words have any other.
END, START = np.uint64(1), np.uint64(2)


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a text, ASCII capitals as small letters, without the end token."""
    return (text or b"").lower().split()


def fold(key: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds))


def pair_hashes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pair of word hashes."""
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + (after ^ after >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return mixed ^ mixed >> np.uint64(29)


def pack(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first, which leaves long runs of zeros to the compression."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpack(packed: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(width, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as their differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint64), dtype=np.uint64)


def count_class(counts: np.ndarray) -> np.ndarray:
    """The class of a context: half octaves of its count in training."""
    return np.minimum(CLASSES - 1, np.round(2 * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


class Chunk:
    """Token numbers of some texts; words are numbered in the order of their hashes."""

    def __init__(self, words: np.ndarray, stream: np.ndarray, lengths: np.ndarray, held_out: np.ndarray) -> None:
        self.words, self.stream, self.lengths, self.held_out = words, stream, lengths, held_out
        self.ends = np.cumsum(lengths)
        before = words[np.concatenate([[0], stream[:-1]])] if len(stream) else np.zeros(0, np.uint64)
        if len(stream):
            before[np.concatenate([[0], self.ends[:-1]])] = START
        self.before = before
        self.pairs, pair = np.unique(pair_hashes(before, words[stream]), return_inverse=True)
        self.pair = pair.astype(np.uint32)
        self.trained = np.repeat(~held_out, lengths)

    @classmethod
    def load(cls, row: dict) -> Chunk:
        opened = lambda name, kind: np.frombuffer(zlib.decompress(row[name]), kind)
        return cls(
            np.frombuffer(row["words"], np.uint64), opened("stream", np.uint32),
            opened("lengths", np.int64), np.frombuffer(row["held"], bool),
        )

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair[self.trained], minlength=len(self.pairs)).astype(np.uint32)

    def contexts(self, totals: np.ndarray, texts: int) -> np.ndarray:
        """How often each pair's first word, or the start, was followed by something in training."""
        some = np.zeros(len(self.pairs), np.int64)
        some[self.pair] = np.arange(len(self.stream))
        first = self.before[some]
        at = np.minimum(np.searchsorted(self.words, first), max(0, len(self.words) - 1))
        return np.where(first == START, texts, totals[at]) if len(self.pairs) else np.zeros(0, np.int64)


class Automaton:
    """The part of the model that a chunk can reach.

    ``arc`` holds the log-probability of each bigram, NaN where there is no arc; ``back`` the weight of
    each word's failure arc, 0 where the word is no state and only the root is left.
    """

    def __init__(self, root: np.ndarray, back: np.ndarray, start_back: float, arc: np.ndarray) -> None:
        self.root, self.back, self.start_back, self.arc = root, back, start_back, arc

    def score(self, words: np.ndarray, arcs: np.ndarray) -> float:
        """The log-probability of a text: one traversal, carrying the failure weight of the state it is in."""
        total, failure = 0.0, self.start_back
        ways = zip(self.arc[arcs].tolist(), self.root[words].tolist(), self.back[words].tolist(), strict=True)
        for weight, from_root, after in ways:
            total += weight if weight == weight else failure + from_root
            failure = after
        return total


def _chunks(documents: DataFrame, key: str, text: str) -> DataFrame:
    """One row per chunk with its words, token numbers and keys; each task fills chunks from its own rows."""
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("stream", T.BinaryType()),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("held", T.BinaryType()),
            T.StructField("keys", T.ArrayType(documents.schema[key].dataType)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()

        def close(number, numbers, streams, lengths, held, keys):
            names = list(numbers)
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in names[1:]], np.uint64)
            hashes = np.concatenate([[END], np.where(hashes < 3, hashes + np.uint64(3), hashes)])
            words, place = np.unique(hashes, return_inverse=True)
            stream = place[np.concatenate(streams)].astype(np.uint32)
            sizes, out = np.array(lengths, np.int64), np.array(held, bool)
            counts = np.bincount(stream[np.repeat(~out, sizes)], minlength=len(words)).astype(np.uint32)
            taken = pa.concat_arrays([pa.array(k, kind) for k in [keys]])
            row = [task << 32 | number, words.tobytes(), counts.tobytes(), zlib.compress(stream.tobytes(), 1),
                   zlib.compress(sizes.tobytes(), 1), out.tobytes()]
            nested = pa.ListArray.from_arrays(pa.array([0, len(taken)], pa.int32()), taken)
            kinds = [pa.int64(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays(
                [*(pa.array([x], k) for x, k in zip(row, kinds, strict=True)), nested], names=[f.name for f in schema]
            )

        def empty():
            numbers = defaultdict(count().__next__)
            numbers[None]  # the end token is number 0
            return numbers, [], [], [], []

        kind, made, held_bytes = None, 0, 0
        open_ = empty()
        for batch in batches:
            kind = batch.schema.field(0).type
            for one, out, body in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                numbers, streams, lengths, held, keys = open_
                body = body.as_py()
                stream = np.array([*map(numbers.__getitem__, tokens(body)), 0], np.uint32)
                streams.append(stream)
                lengths.append(len(stream))
                held.append(bool(out))
                keys.append(one.as_py())
                held_bytes += len(body or b"") + 8
                if held_bytes >= CHUNK_BYTES:
                    yield close(made, *open_)
                    open_, held_bytes, made = empty(), 0, made + 1
        if open_[2]:
            yield close(made, *open_)

    held_out = (fold(F.col(key)) == 0).alias("held_out")
    return documents.select(F.col(key), held_out, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


def _ranges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where the hashes of each of so many equal ranges begin and end in a sorted list."""
    edges = [min((k << 64) // ranges, (1 << 64) - 1) for k in range(1, ranges)]
    return np.concatenate([[0], np.searchsorted(hashes, np.array(edges, np.uint64)), [len(hashes)]])


def _asked(chunk: int, ranges: int, hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> pa.Table:
    cuts = _ranges(hashes, ranges)
    used = [k for k in range(ranges) if cuts[k] < cuts[k + 1]]
    ways = ((pack_sorted, hashes), (pack, counts), (pack, classes))
    parts = [[way(x[cuts[k] : cuts[k + 1]]) for k in used] for way, x in ways]
    return pa.table(
        [pa.array([chunk] * len(used), pa.int64()), pa.array(used, pa.int64()), *(pa.array(p, pa.binary()) for p in parts)],
        names=["chunk", "part", "hashes", "counts", "classes"],
    )


ASKED = "chunk long, part long, hashes binary, counts binary, classes binary"
ANSWERED = "chunk long, part long, totals binary, seen long, once binary, mass binary"


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one range for every chunk that asked, and one row, of chunk -1, with the range's statistics."""
    table = table.combine_chunks()
    lists = [unpack_sorted(x.as_py()) for x in table["hashes"]]
    counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in table["counts"]])
    classes = np.concatenate([unpack(x.as_py(), np.uint8) for x in table["classes"]])
    distinct, first, which = np.unique(np.concatenate(lists), return_index=True, return_inverse=True)
    totals = np.bincount(which, counts, len(distinct)).astype(np.int64)
    kind = classes[first]
    once = np.bincount(kind[totals == 1], minlength=CLASSES).astype(np.int64)
    mass = np.bincount(kind, totals, CLASSES).astype(np.int64)
    own = totals[which]
    ends = np.cumsum([len(x) for x in lists])
    answers = [pack(own[e - len(x) : e]) for x, e in zip(lists, ends, strict=True)]
    rows = table.num_rows
    none = [None] * rows
    return pa.table(
        [
            pa.array([*table["chunk"].to_pylist(), -1], pa.int64()),
            pa.array([*table["part"].to_pylist(), table["part"][0].as_py()], pa.int64()),
            pa.array([*answers, None], pa.binary()),
            pa.array([*none, int((totals > 0).sum())], pa.int64()),
            pa.array([*none, once.tobytes()], pa.binary()),
            pa.array([*none, mass.tobytes()], pa.binary()),
        ],
        names=["chunk", "part", "totals", "seen", "once", "mass"],
    )


def _totals(answers: pa.Table) -> np.ndarray:
    """A chunk's totals in the order of its hashes."""
    rows = sorted(zip(answers["part"].to_pylist(), answers["totals"].to_pylist(), strict=True))
    return np.concatenate([np.zeros(0, np.int64), *(unpack(x, np.int64) for _, x in rows)])


def _statistics(answers: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Distinct entries, and by class those seen once and the total; summed up in Spark to 64 rows."""
    whole = answers.where("chunk = -1")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, once, mass = 0, np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            for s, o, m in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                seen += s
                once += np.frombuffer(o, np.int64)
                mass += np.frombuffer(m, np.int64)
        kinds = np.arange(CLASSES, dtype=np.int32)
        all_seen = np.where(kinds == 0, seen, 0)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kinds, all_seen, once, mass)], names=["k", "s", "o", "m"])

    rows = (
        whole.select("seen", "once", "mass")
        .mapInArrow(opened, "k int, s long, o long, m long")
        .groupBy("k")
        .agg(*[F.sum(c).alias(c) for c in "som"])
        .orderBy("k")
        .collect()
    )
    if not rows:
        return 0, np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    return sum(r["s"] for r in rows), np.array([r["o"] for r in rows]), np.array([r["m"] for r in rows])


def scores(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    A null or blank text is the end token alone. Repeated rows are scored each and count each in training.
    Without any training text all probabilities are those of an empty count. The weight of a failure arc is
    the share of bigrams seen once among all after contexts of about the same count.
    """
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    buckets = max(1, -(-size // (2 * CHUNK_BYTES)))
    name = f"lm_chunks_{uuid.uuid4().hex}"
    # Stored by chunk, so that answers come to the chunks and the token numbers are never shuffled.
    made = _chunks(documents, key, text)
    made.write.bucketBy(buckets, "chunk").option("path", fresh_dir(spark, "lm_chunks")).saveAsTable(name)
    chunks = spark.table(name)
    kind = documents.schema[key].dataType

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                hashes = np.frombuffer(words, np.uint64)
                classes = np.where(hashes == END, 1, 0).astype(np.uint8)
                asked = _asked(chunk, ranges, hashes, np.frombuffer(counts, np.uint32), classes)
                yield from asked.to_batches()

    words = chunks.select("chunk", "words", "counts").mapInArrow(ask_words, ASKED)
    words = settle(words.groupBy("part").applyInArrow(_answer, ANSWERED), "lm_words")
    distinct, _, mass = _statistics(words)
    train_tokens, texts = int(mass.sum()), int(mass[1])

    def ask_pairs(chunk_rows: pa.Table, answers: pa.Table) -> pa.Table:
        made = []
        for row in chunk_rows.to_pylist():
            chunk = Chunk.load(row)
            contexts = chunk.contexts(_totals(answers), texts)
            made.append(_asked(row["chunk"], ranges, chunk.pairs, chunk.pair_counts(), count_class(contexts)))
        return pa.concat_tables(made) if made else _asked(0, 1, *(np.zeros(0, k) for k in (np.uint64, np.uint32, np.uint8)))

    columns = ["chunk", "words", "stream", "lengths", "held"]
    told = words.where("chunk >= 0").select("chunk", "part", "totals")
    pairs = chunks.select(*columns).groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(ask_pairs, ASKED)
    pairs = settle(pairs.groupBy("part").applyInArrow(_answer, ANSWERED), "lm_pairs")
    _, once, mass = _statistics(pairs)
    unseen = (once + 0.5) / (mass + 1.0)

    result = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
            *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score")),
        ]
    )
    below = math.log10(train_tokens + ADD * (distinct + 1))

    def score(chunk_rows: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = np.array(answers["kind"].to_pylist())
        of_words, of_pairs = (_totals(answers.filter(pa.array(kinds == k))) for k in ("words", "pairs"))
        made = []
        for place, row in enumerate(chunk_rows.drop_columns(["keys"]).to_pylist()):
            chunk = Chunk.load(row)
            root = np.log10(of_words + ADD) - below
            known = of_words > 0
            share = unseen[count_class(of_words)]
            back = np.where(known, np.log10(share), 0.0)
            contexts = chunk.contexts(of_words, texts)
            rest = unseen[count_class(contexts)]
            some = np.zeros(len(chunk.pairs), np.int64)
            some[chunk.pair] = chunk.stream
            with np.errstate(invalid="ignore", divide="ignore"):
                seen = (1 - rest) * of_pairs / contexts + rest * 10.0 ** root[some]
                arc = np.where(of_pairs > 0, np.log10(seen), np.nan)
            start = float(np.log10(unseen[count_class(np.array([texts]))])[0]) if texts else 0.0
            model = Automaton(root, back, start, arc)
            begins = (chunk.ends - chunk.lengths).tolist()
            bounds = list(zip(begins, chunk.ends.tolist(), strict=True))
            marks = np.array(begins, np.int64)
            made.append(
                pa.table(
                    [
                        chunk_rows["keys"].combine_chunks()[place].values if chunk_rows.num_rows else [],
                        pa.array(chunk.held_out),
                        pa.array(chunk.lengths),
                        pa.array(np.add.reduceat(known[chunk.stream].astype(np.int64), marks)),
                        pa.array(np.full(len(marks), train_tokens)),
                        pa.array(np.add.reduceat(root[chunk.stream], marks)),
                        pa.array([model.score(chunk.stream[a:b], chunk.pair[a:b]) for a, b in bounds], pa.float64()),
                    ],
                    names=[f.name for f in result],
                )
            )
        return pa.concat_tables(made) if made else pa.table([[]] * 7, names=[f.name for f in result])

    both = words.select("chunk", "part", "totals", F.lit("words").alias("kind")).union(
        pairs.select("chunk", "part", "totals", F.lit("pairs").alias("kind"))
    )
    return (
        chunks.select(*columns, "keys")
        .groupBy("chunk")
        .cogroup(both.where("chunk >= 0").groupBy("chunk"))
        .applyInArrow(score, result)
    )


def op5_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base and the bigram score of every whole document."""
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
