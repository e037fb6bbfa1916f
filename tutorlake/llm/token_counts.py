"""Exact token counts of every prefix of a text under a byte-pair vocabulary, by dynamic programming.

Byte-pair encoding has the property that a text's encoding ends in the one token ``t`` that stands well
beside the last token ``p`` of the encoding of what precedes it, that is, where ``p + t`` alone is encoded
as ``p, t``. One pass from left to right therefore gives the last token and the number of tokens of every
prefix. Truncation and budget questions are then lookups, without encoding any prefix again.

Texts are cut where no token can reach across: before a space that follows something else, and around
characters that the vocabulary lacks. Counts of the parts add up, and equal parts are worked out once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.llm.workers import kept

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
REMEMBERED = 400_000
SPACE = "▁"


class PrefixCounter:
    """Prefix counts for a sentencepiece byte-pair model with byte fallback and no normalization.

    ``REMEMBERED`` bounds each of the two memories of parts and of token pairs; a full memory starts anew.
    """

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        odd = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        ids = [i for i in range(model.get_piece_size()) if not any(f(i) for f in odd)]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("tokens reach across the start of a word")
        starts = {p[:k] for p in self.scores for k in range(1, len(p) + 1)}
        self.starts = {p: p in self.scores for p in starts}
        letters = re.escape("".join(sorted({c for p in self.scores for c in p} - {SPACE})))
        self.parts = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|[^{letters}{SPACE}]+")
        self.known: dict[str, int] = {}
        self.beside: dict[str, dict[str, bool]] = {}
        self.pairs = 0

    def encode(self, text: str) -> list[str]:
        """The merges one by one: of all neighbours that form a token, the best-scored, leftmost first."""
        tokens = list(text)
        while len(tokens) > 1:
            scored = [
                (-self.scores[a + b], k)
                for k, (a, b) in enumerate(zip(tokens, tokens[1:], strict=False))
                if a + b in self.scores
            ]
            if not scored:
                break
            _, k = min(scored)
            tokens[k : k + 2] = [tokens[k] + tokens[k + 1]]
        return tokens

    def fits(self, before: str, token: str) -> bool:
        """Whether ``before`` and ``token`` side by side are encoded as just these two."""
        if self.pairs >= REMEMBERED:
            self.beside.clear()
            self.pairs = 0
        found = self.encode(before + token) == ([before, token] if before else [token])
        self.beside.setdefault(before, {})[token] = found
        self.pairs += 1
        return found

    def part_counts(self, part: str) -> list[int]:
        """Token counts of the prefixes of a part, the empty one first."""
        if part[-1] not in self.starts:
            counts = [0]
            for c in part:
                counts.append(counts[-1] + len(c.encode()))
            return counts
        size = len(part)
        last: list[str | None] = [""] + [None] * size
        counts = [0] * (size + 1)
        for at in range(size):
            before, count = last[at], counts[at] + 1
            known = self.beside.get(before, {})
            for end in range(at + 1, size + 1):
                token = part[at:end]
                whole = self.starts.get(token)
                if whole is None:
                    break
                if whole and last[end] is None:
                    fits = known.get(token)
                    if self.fits(before, token) if fits is None else fits:
                        last[end] = token
                        counts[end] = count
        return counts

    def split(self, text: str) -> list[str]:
        return self.parts.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def part_count(self, part: str) -> int:
        found = self.known.get(part)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[part] = self.part_counts(part)[-1]
        return found

    def count(self, text: str) -> int:
        return sum(map(self.part_count, self.split(text)))

    def prefix_counts(self, text: str) -> np.ndarray:
        """``counts[i]``: the tokens of the first ``i`` characters, taken as a text of their own."""
        counts = [np.zeros(1, np.int32)]
        done = 0
        for part in self.split(text):
            own = np.array(self.part_counts(part)[1:], np.int32) + done
            counts.append(own)
            done = int(own[-1])
        found = np.concatenate(counts)
        return np.delete(found, 1) if text else found


def _counter(model_file: str) -> PrefixCounter:
    return kept(("prefix counter", model_file), lambda: PrefixCounter(model_file))


def longest_within(counts: np.ndarray, budget: int) -> int:
    """The length of the longest prefix of at most ``budget`` tokens; counts may fall as a text grows."""
    return int(np.nonzero(counts <= budget)[0][-1])


def _mapped(documents: DataFrame, text: str, fields: list[T.StructField], work) -> DataFrame:
    """All columns, with those of ``fields`` replaced by what ``work`` makes of a batch of texts."""
    names = [f.name for f in fields]
    others = [c for c in documents.columns if c not in names]
    kept = [c for c in others if c != text]
    schema = T.StructType([*(documents.schema[c] for c in kept), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            state, columns = work(state, [x or "" for x in batch.column(len(kept)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], names=[*kept, *names])

    return documents.select(*kept, F.col(text).alias("__text")).mapInArrow(run, schema)


def count_tokens(documents: DataFrame, model_file: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """All columns but the text, and its token count. A null text counts as empty and has 0 tokens."""

    def work(state, texts):
        counter = state or _counter(model_file)
        return counter, [pa.array([counter.count(x) for x in texts], pa.int64())]

    return _mapped(documents, text, [T.StructField(name, T.LongType())], work)


def with_prefix_counts(documents: DataFrame, model_file: str, text: str = "text", name: str = "prefix_tokens") -> DataFrame:
    """All columns but the text, and the token counts of all its prefixes, the empty one first."""

    def work(state, texts):
        counter = state or _counter(model_file)
        return counter, [pa.array([counter.prefix_counts(x) for x in texts], pa.list_(pa.int32()))]

    return _mapped(documents, text, [T.StructField(name, T.ArrayType(T.IntegerType()))], work)


def truncate(documents: DataFrame, model_file: str, budget: int, text: str = "text") -> DataFrame:
    """All columns, the text cut to its longest prefix of at most ``budget`` tokens, and ``kept_tokens``."""

    def work(state, texts):
        counter = state or _counter(model_file)
        cut, sizes = [], []
        for x in texts:
            counts = counter.prefix_counts(x)
            end = longest_within(counts, budget)
            cut.append(x[:end])
            sizes.append(int(counts[end]))
        return counter, [pa.array(cut, pa.string()), pa.array(sizes, pa.int64())]

    renamed = documents.withColumn("__body", F.col(text)).drop(text, "kept_tokens")
    fields = [T.StructField(text, T.StringType()), T.StructField("kept_tokens", T.LongType())]
    return _mapped(renamed, "__body", fields, work)


def op7_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it is over the limit."""
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text"
    )
    counted = count_tokens(documents, public_tokenizers.path(MODEL))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
