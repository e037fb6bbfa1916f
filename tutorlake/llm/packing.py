"""Vector best-fit packing of tokenized documents into training sequences.

A sequence has three capacities: tokens, documents and attention cost, the sum of its pieces' squared
lengths. A piece goes into the open sequence that has room in every respect and is left with the least
weighted residual, or, by the other rule, fits the residual best in the weighted dot product.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.llm.workers import kept
from tutorlake.sources.tables import settle

TOKENIZER = "word_bpe_49k.json"
LENGTH = 2048
END = 0
GROUP = 6000
REMEMBERED = 400_000
AT_ONCE = 20_000
# Words of one call; the tokenizer takes more time a word for many more.
ASKED = 256
MARKS = ".,;:!?"


@dataclass(frozen=True)
class Limits:
    """What a sequence can hold, and the weights of tokens, documents and attention cost in the choice.

    As given, tokens alone can close a sequence: a piece has at least one token, and a sum of squares is at
    most the square of the sum. The other two bind when they are set lower.
    """

    tokens: int = LENGTH
    documents: int = LENGTH
    attention: int = LENGTH * LENGTH
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "residual"


class WordEncoder:
    """Token ids as little-endian 32-bit bytes, for a tokenizer whose tokens never span white space.

    Texts are cut at spaces and line ends alone; any other white space is left to the tokenizer. So is
    everything but marks after nothing but letters, which are tokens of their own. Where the tokenizer lowers
    letters one by one, a word of letters has the ids of its lower case. Equal words are encoded once, and new
    words go to the tokenizer ``ASKED`` at a time, as their tokens tell by where they start which word they are of.
    Words are looked up ``AT_ONCE``. A memory of ``REMEMBERED`` words starts anew, and takes words over from the one before as they come up.
    """

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str("AÀΣЖ") == "aàσж"
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def parts(self, word: str) -> tuple[str, str]:
        """A word the tokenizer is to be asked for, and the marks after it; both together have the ids of ``word``."""
        letters = word.rstrip(MARKS)
        lower = letters
        if self.lowers:
            # A sigma alone is lowered by its place in the word.
            lower = "".join(map(str.lower, letters)) if "Σ" in letters else letters.lower()
        if not letters.isalpha() or not lower.isalpha():
            return word, ""
        return lower, word[len(letters) :]

    def learn(self, words: set[str]) -> None:
        """Take words into the memory that are not in it."""
        known, before = self.known, self.before
        cut, wanted = [], set()
        for word in words:
            found = before.get(word)
            if found is not None:
                known[word] = found
            elif word.isalpha() and word.islower():
                wanted.add(word)
            else:
                head, marks = self.parts(word)
                cut.append((word, head, marks))
                wanted.update((head, marks))
        alone, together = [], []
        for word in wanted:
            if word in known:
                continue
            found = before.get(word)
            if found is not None:
                known[word] = found
            elif word.isascii() and word[0] not in MARKS or word.isalpha() and len(word.lower()) == len(word):
                together.append(word)
            else:
                alone.append(word)
        for word in alone:
            known[word] = self.ids(word)[0]
        for turn in range(0, len(together), ASKED):
            some = together[turn : turn + ASKED]
            coded, starts = self.ids(" ".join(some))
            firsts = np.cumsum([0, *(len(word) + 1 for word in some)])
            cuts = (4 * np.searchsorted(starts, firsts)).tolist()
            for word, at, end in zip(some, cuts[:-1], cuts[1:], strict=True):
                known[word] = coded[at:end]
        for word, head, marks in cut:
            known[word] = known[head] + known[marks]

    def ids(self, words: str) -> tuple[bytes, np.ndarray]:
        """The ids, and where in ``words`` the token of each starts."""
        coded = self.tokenizer.encode(words, add_special_tokens=False)
        return np.array(coded.ids, "<u4").tobytes(), np.array(coded.offsets, np.int64).reshape(-1, 2)[:, 0]

    def looked_up(self, words: list[str]) -> list[bytes]:
        if len(self.known) >= REMEMBERED:
            self.before, self.known = self.known, {"": b""}
        found = list(map(self.known.get, words))
        new = [at for at, ids in enumerate(found) if ids is None]
        if new:
            self.learn({words[at] for at in new})
            for at in new:
                found[at] = self.known[words[at]]
        return found

    def texts(self, texts: Iterable[str]) -> Iterator[bytes]:
        words: list[str] = []
        ends = [0]

        def coded() -> Iterator[bytes]:
            found: list[bytes] = []
            for at in range(0, len(words), AT_ONCE):
                found += self.looked_up(words[at : at + AT_ONCE])
            for at, end in zip(ends[:-1], ends[1:], strict=True):
                yield b"".join(found[at:end])

        for text in texts:
            words += text.replace("\n", " ").split(" ")
            ends.append(len(words))
            if len(words) >= AT_ONCE:
                yield from coded()
                words, ends = [], [0]
        yield from coded()

    def text(self, text: str) -> bytes:
        return next(self.texts([text]))


def pieces(
    documents: DataFrame,
    tokenizer_file: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    keep_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: ``(key, piece, start, length, ids_crc32)`` and, if asked for, ``ids``.

    A document is its ids and one closing id. Only documents of more than ``length`` ids are cut. A null
    or empty text is the closing id alone; repeated rows give repeated pieces.
    """
    fields = [
        documents.schema[key],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("word encoder", tokenizer_file), lambda: WordEncoder(tokenizer_file))
        for batch in batches:
            row, piece, start, size, crc, ids = [], [], [], [], [], []
            for k, x in enumerate(encoder.texts(x or "" for x in batch.column(1).to_pylist())):
                coded = x + END.to_bytes(4, "little")
                for n, at in enumerate(range(0, len(coded), 4 * length)):
                    part = coded[at : at + 4 * length]
                    row.append(k)
                    piece.append(n)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, size, crc)),
            ]
            columns += [pa.array(ids, pa.list_(pa.int32()))] * keep_ids
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return documents.select(key, text).mapInArrow(run, T.StructType(fields))


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of each piece, the longest placed first, ties in the given order."""
    capacity = np.array([limits.tokens, limits.documents, limits.attention], np.float64)
    needs = np.stack([lengths, np.ones(len(lengths)), lengths.astype(np.float64) ** 2], axis=1) / capacity
    slack = 1e-9
    if len(lengths) and (needs > 1 + slack).any():
        raise ValueError("a piece is larger than an empty sequence")
    weights = np.array(limits.weights)
    order = np.argsort(-lengths, kind="stable")
    smallest = np.minimum.accumulate(needs[order][::-1], axis=0)[::-1]
    left = np.ones((0, 3))
    names = np.zeros(0, np.int64)
    used = np.zeros(0, np.int64)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for turn, item in enumerate(order):
        need = needs[item]
        if turn % 64 == 0 and len(left):
            alive = (left + slack >= smallest[turn]).all(axis=1)
            left, names, used = left[alive], names[alive], used[alive]
        room = np.nonzero((left + slack >= need).all(axis=1))[0]
        if len(room):
            after = left[room] - need
            score = -(weights * after**2).sum(axis=1) if limits.rule == "residual" else -(weights * need * left[room]).sum(axis=1)
            best = room[np.argmax(score)]
        else:
            best = len(left)
            left = np.vstack([left, np.ones(3)])
            names, used = np.append(names, made), np.append(used, 0)
            made += 1
        sequence[item], offset[item] = names[best], used[best]
        left[best] -= need
        used[best] += lengths[item]
    return sequence, offset


def numbered(rows: DataFrame) -> DataFrame:
    """All rows with ``__copy``, the number of each among the rows equal to it, from 0.

    Equal rows are counted per partition and told apart by where the counts of their partition begin, so no
    task holds more of them than one partition had. The numbers are the same however the rows are stored.
    """
    names = rows.columns
    counts = rows.withColumn("__part", F.spark_partition_id()).groupBy(*names, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.withColumn("__from", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")))
    copies = F.explode(F.sequence("__from", F.col("__from") + F.col("__n") - 1))
    return begun.repartition(*names, "__part").select(*names, copies.alias("__copy"))


def pack(cut: DataFrame, limits: Limits = Limits(), key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """All pieces with ``sequence_id`` and ``offset``; every sequence is filled from 0 without gaps.

    Pieces are dealt at random into groups of about ``group``, equal ones too, and packed group by group, so
    work and memory of a task are bounded. A group wastes room in about one sequence of the many it fills.
    """
    groups = max(1, round(cut.count() / group))
    mark = F.xxhash64(key, "piece", "ids_crc32", "start", "__copy")
    dealt = numbered(cut).withColumn("__group", F.pmod(mark, F.lit(groups))).drop("__copy")
    schema = T.StructType(
        [*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(key, "ascending"), ("piece", "ascending")])
        sequence, offset = best_fit(table["length"].to_numpy(), limits)
        name = sequence + (table["__group"][0].as_py() << 32)
        table = table.drop_columns(["__group"])
        return table.append_column("sequence_id", pa.array(name)).append_column("offset", pa.array(offset))

    return dealt.groupBy("__group").applyInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence with its ids in order; ``packed`` must carry ``ids``."""
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"))
    )


def pack_documents(documents: DataFrame, tokenizer_file: str, limits: Limits = Limits(), key: str = "doc_id") -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(settle(pieces(documents, tokenizer_file, key, length=limits.tokens), "pieces"), limits, key)


def op3_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(documents, public_tokenizers.path(TOKENIZER))
