"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of ``n`` letters may occur with up to ``n * RATE`` edits. Cut into one piece more than
that, at least one piece must occur unchanged, whatever the edits. One automaton finds all pieces of all
items in a text; around each hit the item is verified with Myers' bit-parallel edit distance. Pieces are
paired up like the leaves of a tree, and a hit is verified upwards, each pair with its own share of the
edits: by the same pigeonhole argument some piece passes at every level, and chance hits end at the first.

Texts and items are compared in small letters, with every run of white space and ASCII punctuation as one
space. An item of fewer than ``EXACT_BELOW`` words is too short for edits and is looked for as it is, at whole
words. Items travel to the tasks in blocks of at most ``BLOCK_BYTES``, so a large benchmark takes several
passes over the documents, one after another, instead of more memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.sources.tables import drop_folder, settle, stored_paths

RATE = 0.1
EXACT_BELOW = 5
# Least words of an item that makes a document go; shorter strings are common in texts that hold no benchmark.
MIN_WORDS = 5
BLOCK_BYTES = 4_000_000
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_WORD = re.compile(r"[^\W_]+|[^\x00-\x7f]+")


def plain(text: str | None) -> str:
    """Small letters, with white space and ASCII punctuation as single spaces."""
    return b" ".join((text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split()).decode()


def budget(item: str, rate: float = RATE) -> int:
    return int(len(item) * rate)


@dataclass(frozen=True)
class Node:
    """A stretch of an item with the edits it may have; a piece has none."""

    start: int
    end: int
    errors: int
    parent: int


def cut(item: str, errors: int) -> list[Node]:
    """The tree over ``errors + 1`` pieces of nearly equal length that cover the item; the item comes first.

    A node of ``k`` edits has parts of ``k // 2`` and ``k - 1 - k // 2``: if both had more, so had the node.
    """
    ends = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    nodes: list[Node] = []
    todo = [(0, errors, -1)]
    while todo:
        first, edits, parent = todo.pop()
        nodes.append(Node(ends[first], ends[first + edits + 1], edits, parent))
        if edits:
            left = edits // 2
            todo.append((first, left, len(nodes) - 1))
            todo.append((first + left + 1, edits - 1 - left, len(nodes) - 1))
    return nodes


class Pattern:
    """An item for Myers' algorithm; one Python integer holds the whole column of the distance table."""

    def __init__(self, item: str) -> None:
        self.size = len(item)
        self.full = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)
        self.letters: dict[str, int] = {}
        for k, c in enumerate(item):
            self.letters[c] = self.letters.get(c, 0) | 1 << k

    def best_end(self, text: str, errors: int) -> tuple[int, int] | None:
        """``(distance, end)``: the least distance, at most ``errors``, of a part of the text; the first end."""
        up, down, score = self.full, 0, self.size
        full, top, letters = self.full, self.top, self.letters
        best = None
        left = len(text)
        for at, c in enumerate(text):
            match = letters.get(c, 0)
            diagonal = (((match & up) + up) ^ up) | match | down
            plus = down | ~(diagonal | up) & full
            minus = up & diagonal
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            if score <= errors and (best is None or score < best[0]):
                best = (score, at + 1)
            if score - (left - at - 1) > (errors if best is None else best[0]):
                break
            plus = plus << 1 & full
            minus = minus << 1 & full
            up = minus | ~(diagonal | plus) & full
            down = plus & diagonal
        return best


class Searcher:
    """All items of a block, ready to search texts."""

    def __init__(self, items: list[tuple[object, str]], rate: float = RATE, min_words: int = 1) -> None:
        import ahocorasick

        self.keys, self.items, self.trees = [], [], []
        self.pieces = ahocorasick.Automaton()
        self.patterns: dict[str, Pattern] = {}
        self.whole: set[int] = set()
        found: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            item = plain(text)
            words = item.count(" ") + 1
            if not item or words < min_words:
                continue
            if words < EXACT_BELOW:
                self.whole.add(len(self.items))
            tree = cut(item, 0 if words < EXACT_BELOW else budget(item, rate))
            for n, node in enumerate(tree):
                if not node.errors:
                    found.setdefault(item[node.start : node.end], []).append((len(self.items), n))
            self.keys.append(key)
            self.items.append(item)
            self.trees.append(tree)
        for piece, owners in found.items():
            self.pieces.add_word(piece, (len(piece), owners))
        if found:
            self.pieces.make_automaton()

    def pattern(self, text: str) -> Pattern:
        if text not in self.patterns:
            self.patterns[text] = Pattern(text)
        return self.patterns[text]

    def passes(self, body: str, number: int, leaf: int, start: int, seen: dict[tuple[int, int, int], bool]) -> bool:
        """Whether every stretch above a piece may occur where the piece puts it; ``start`` is the item's."""
        tree, item = self.trees[number], self.items[number]
        at = tree[leaf].parent
        while at > 0:
            mark = (number, at, start)
            if mark not in seen:
                node = tree[at]
                window = body[max(0, start + node.start - node.errors) : max(0, start + node.end + node.errors)]
                seen[mark] = self.pattern(item[node.start : node.end]).best_end(window, node.errors) is not None
            if not seen[mark]:
                return False
            at = tree[at].parent
        return True

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item number, distance, start, end)`` of the best occurrence per item, in the plain text."""
        body = plain(text)
        if not body or not self.items:
            return []
        exact: dict[int, int] = {}
        starts: dict[int, set[int]] = {}
        seen: dict[tuple[int, int, int], bool] = {}
        for end, (size, owners) in self.pieces.iter(body):
            for number, leaf in owners:
                start = end + 1 - size - self.trees[number][leaf].start
                if number in exact or start in starts.get(number, ()):
                    continue
                if number in self.whole:
                    if (start == 0 or body[start - 1] == " ") and body[end + 1 : end + 2] in ("", " "):
                        exact[number] = start
                elif start >= 0 and body.startswith(self.items[number], start):
                    exact[number] = start
                elif self.passes(body, number, leaf, start, seen):
                    starts.setdefault(number, set()).add(start)
        hits = [(n, 0, start, start + len(self.items[n])) for n, start in exact.items()]
        for number, places in starts.items():
            if number not in exact and (best := self.verify(body, number, sorted(places))):
                hits.append(best)
        return hits

    def verify(self, body: str, number: int, places: list[int]) -> tuple[int, int, int, int] | None:
        """The best occurrence of an item that starts about one of the places."""
        item, reach = self.items[number], self.trees[number][0].errors
        spans: list[list[int]] = []
        for start in places:
            a, b = max(0, start - reach), max(0, start + len(item) + reach)
            if spans and a <= spans[-1][0] + 2 * reach:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        best = None
        for a, b in spans:
            limit = reach if best is None else best[0] - 1
            found = self.pattern(item).best_end(body[a:b], limit) if limit >= 0 else None
            if found:
                best = (found[0], a, a + found[1])
        if best is None:
            return None
        distance, a, end = best
        back = Pattern(item[::-1]).best_end(body[a:end][::-1], distance)
        return number, distance, end - back[1], end


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where a stretch of the plain text lies in the text itself; whole words are taken."""
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = text
    at, first, last = 0, None, 0
    for word in _WORD.finditer(lowered):
        size = word.end() - word.start()
        if at + size > start and first is None:
            first = word.start()
        if at < end:
            last = word.end()
        at += size + 1
    return first or 0, last


def item_blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[tuple[bool, list[tuple[object, str]]]]:
    """The items with a text in blocks of about ``BLOCK_BYTES``, dealt by hash, and whether more follow.

    One block may be empty. A block is read when it is asked for, so only one is held at a time.
    """
    usable = benchmark.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    size = usable.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        part = usable.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == block)
        yield block + 1 < blocks, [tuple(r) for r in part.collect()]


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    min_words: int = 1,
) -> DataFrame:
    """``(key, item_key, distance, start, end)``: each item that a document holds, at its best place.

    ``start`` and ``end`` are characters of the text, at whole words. Items of fewer than ``min_words``
    words, empty or null items and null texts match nothing; an item listed twice is found twice, a repeated row
    has its own matches. Of several blocks of items, each but the last is matched and its result written before the
    next one is read.
    """
    schema = T.StructType(
        [
            documents.schema[key],
            T.StructField(item_key, benchmark.schema[item_key].dataType),
            *(T.StructField(n, T.IntegerType()) for n in ("distance", "start", "end")),
        ]
    )
    found = []
    for more, items in item_blocks(benchmark, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(items, rate, min_words)
            for batch in batches:
                rows, hits = [], []
                for k, body in enumerate(batch.column(1).to_pylist()):
                    for number, distance, a, b in searcher.search(body):
                        rows.append(k)
                        hits.append((searcher.keys[number], distance, *original_span(body, a, b)))
                columns = list(zip(*hits, strict=True)) if hits else [[]] * 4
                kind = pa.RecordBatch.from_pylist([{"k": items[0][0] if items else None}]).schema.field("k").type
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(columns[0], kind),
                        *(pa.array(c, pa.int32()) for c in columns[1:]),
                    ],
                    names=[f.name for f in schema.fields],
                )

        hits = documents.select(key, text).mapInArrow(run, schema)
        found.append(settle(hits, "benchmark-hits") if more else hits)
    return reduce(DataFrame.union, found)


def clean(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; a null text is kept.

    Items of fewer than ``min_words`` words, such as names and numbers, let no document go. Items are looked for in
    each document where it stands, so nothing is joined or shuffled. Of several blocks of items, each but the last
    has its rest written, and the rest before it deleted, before the next one is read.
    """
    left, written = documents, ""
    for more, items in item_blocks(benchmark, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(items, rate, min_words)
            for batch in batches:
                bodies = batch.column(batch.schema.get_field_index(text)).to_pylist()
                yield batch.filter(pa.array([not searcher.search(x) for x in bodies], pa.bool_()))

        left = left.mapInArrow(run, documents.schema)
        if more:
            with stored_paths() as paths:
                left = settle(left, "benchmark-rest")
            if written:
                drop_folder(documents.sparkSession, written)
            written = paths[0]
    return left


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in any whole document, with its edit distance and span."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return matches(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
