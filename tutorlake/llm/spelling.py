"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced letter.

The words stand in two tries, one of the words and one of the words read backwards, kept as tables of edges.
An edge leads from a node to the next one with several children and is labelled with the letters between;
the table is as large as the vocabulary, not as its letters. A frontier of states
``(word, position, node, edits)`` is joined with the edges of one level after another. A word walks its own path
without edits; where the path parts, it may take another edge with a greater letter (a replacement) or with a letter
that it does not have (an insertion), and from there on the letters must agree. So every pair is met once: from
the word with the smaller letter, or from the shorter word. States that end with one edit are neighbours.

A word of ``n`` letters takes edits behind its first ``n // 2`` letters in the one trie, and before them in the
other. The crowded tops of both tries are therefore never searched.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.session import fresh_dir
from tutorlake.sources.tables import settle

LEAST_LETTERS = 5
LEAST_COUNT = 3
# Words a task holds before it passes their counts on.
HELD = 200_000
# Edits start behind two letters at least, since no word is shorter than four.
TOP = 2
RUN = re.compile("[a-z\u00C0-\u00FF]+")
DAMAGED = 97
_STEP = 0x9E3779B97F4A7C15
_SALTS = (0x8CB92BA72F3D8DD7, 0x2545F4914F6CDD1D)


def damaged(word: str, check: int) -> str:
    """The word without one letter if the checksum is a multiple of 97."""
    if check % DAMAGED:
        return word
    at = check % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    documents: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``(word, n)`` of all words of at least ``least_letters`` letters that stand at least ``least_count`` times.

    Words are runs of letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case; some lose a letter, by the
    checksum of document id and word. A null text has no words; a null id counts as an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        counts: dict[str, int] = {}
        crc = zlib.crc32
        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1), strict=True):
                own: dict[str, int] = {}
                for word in RUN.findall((body.as_py() or b"").lower().decode()):
                    if len(word) >= least_letters:
                        own[word] = own.get(word, 0) + 1
                start = crc(f"{name.as_py() or ''}:".encode())
                for word, n in own.items():
                    check = crc(word.encode(), start)
                    if check % DAMAGED == 0:
                        word = damaged(word, check)
                        if len(word) < least_letters:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > HELD:
                    yield flush()
        yield flush()

    found = documents.select(F.col(key).cast("string"), F.col(text).cast("binary").alias("__text")).mapInArrow(work, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _nodes(words: list[str], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word the node numbers of its prefixes of ``TOP`` letters and more, one after another, and how many.

    A node is known by 64 bits of its letters. If two ever shared a number, their edges would be tried
    together; what is found is looked up among the words anyway.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(sizes)
    at = np.arange(len(letters)) - np.repeat(ends - sizes, sizes)
    powers = np.ones(int(sizes.max(initial=0)) + 1, np.uint64)
    powers[1:] = _STEP
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * np.cumprod(powers, dtype=np.uint64)[at], dtype=np.uint64)])
    value = sums[1:] - np.repeat(sums[ends - sizes], sizes)
    value ^= np.uint64(salt)
    value = (value ^ value >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ value >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(31)
    return value[at >= TOP - 1].view(np.int64), np.maximum(sizes - TOP + 1, 0)


def _paths(words: DataFrame) -> DataFrame:
    """``(word, back, nodes)``: each word as it is and backwards, with the nodes of its prefixes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for back in (False, True):
                own = [w[::-1] if back else w for w in batch.column(0).to_pylist()]
                values, sizes = _nodes(own, _SALTS[back])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                nodes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([back] * len(own)), nodes], names=["word", "back", "nodes"])

    return words.select("word").mapInArrow(work, "word string, back boolean, nodes array<long>")


def _part(word: str, start: str, size: str | None = None) -> Column:
    """Letters of a word from place ``start``, counted from 0."""
    return F.expr(f"substring({word}, {start} + 1" + (f", {size})" if size else ")"))


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges and first states of both tries.

    Edges are ``(level, node, label, child, ends)``: ``child`` is null behind a word's end where no other goes on,
    and ``ends`` says that a word ends at the child. States are ``(level, node, word, back, position)``, the first
    node of each word's path behind which it takes edits. A node's level is the number of nodes above it.
    """
    paths = settle(_paths(words), "paths")
    prefixes = paths.select("word", "back", F.posexplode("nodes").alias("at", "node")).select(
        "word", "back", "node", (F.col("at") + TOP).alias("depth")
    )
    # Where words part: several next letters, or one and a word's end, which counts as 0.
    letter = F.ascii(_part("word", "depth", "1"))
    parting = (
        prefixes.groupBy("node")
        .agg(F.min(letter).alias("low"), F.max(letter).alias("high"))
        .where("low < high")
        .select("node", (F.col("low") == 0).alias("ends"))
    )
    stops = F.array_sort(F.collect_list(F.struct("depth", "node", "ends")))
    own = settle(prefixes.join(parting, "node").groupBy("word", "back").agg(stops.alias("stops")), "stops")
    steps = own.select("word", "back", "stops", F.posexplode("stops").alias("level", "stop")).withColumn(
        "next", F.get("stops", F.col("level") + 1)
    )
    last = F.col("next").isNull()
    edges = (
        steps.select("word", "level", "next", last.alias("last"), F.col("stop.node").alias("node"), F.col("stop.depth").alias("depth"))
        .where(~F.col("last") | (F.col("depth") < F.length("word")))
        .select(
            "level",
            "node",
            F.when(F.col("last"), _part("word", "depth")).otherwise(_part("word", "depth", "next.depth - depth")).alias("label"),
            F.col("next.node").alias("child"),
            F.coalesce("next.ends", F.lit(True)).alias("ends"),
        )
    )
    inner = edges.where("child is not null").distinct()
    half = F.floor(F.length("word") / 2)
    behind = F.when(F.col("back"), F.length("word") - half).otherwise(half)
    first = F.array_position(F.transform("stops", lambda s: s["depth"] >= behind), True)
    states = own.withColumn("level", (first - 1).cast("int")).where("level >= 0")
    states = states.withColumn("stop", F.get("stops", F.col("level")))
    begun = states.select("level", "word", "back", F.col("stop.node").alias("node"), F.col("stop.depth").cast("int").alias("position"))
    return inner.union(edges.where("child is null")), begun


def _stored_by_level(rows: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(rows.sparkSession, name)
    rows.write.partitionBy("level").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _advanced(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """All states one edge further on.

    A state without edits meets all edges of its node, one with an edit only the edge of its next letter.
    """
    first, own = F.expr("substring(label, 1, 1)"), _part("word", "position", "1")
    rest = _part("label", "1")

    def state(position: str, edits: int, near: Column) -> Column:
        return F.struct(F.expr(position).alias("position"), F.lit(edits).alias("edits"), near.alias("near"))

    def edited(after: str) -> Column:
        return F.concat(_part("word", "0", "position"), first, _part("word", after))

    # Edges of one node differ in their first letter, and the word's own edge agrees with it as a whole.
    exact = F.when(first == own, state("position + length(label)", 0, F.lit(None).cast("string")))
    replaced = F.when(
        (own != "") & (first > own) & (rest == _part("word", "position + 1", "length(label) - 1")),
        state("position + length(label)", 1, edited("position + 1")),
    )
    inserted = F.when(
        (first != own) & (rest == _part("word", "position", "length(label) - 1")),
        state("position + length(label) - 1", 1, edited("position")),
    )
    moves = F.filter(F.array(exact, replaced, inserted), lambda m: m.isNotNull())
    edges = edges.select("node", "label", "child", "ends")
    fresh = (
        frontier.where("edits = 0")
        .join(edges, "node")
        .select("word", "back", "child", "ends", F.inline(moves))
        .where("child is not null or (edits = 1 and position = length(word))")
    )
    lettered = edges.withColumn("letter", first)
    late = (
        frontier.where("edits = 1")
        .withColumn("letter", own)
        .join(lettered, ["node", "letter"])
        .where(F.col("label") == _part("word", "position", "length(label)"))
        .select("word", "back", "child", "ends", F.expr("position + length(label)").alias("position"), "edits", "near")
        .where("child is not null or position = length(word)")
    )
    return fresh.union(late)


def near_words(words: DataFrame) -> DataFrame:
    """``(word, near)``: every pair of the words ``word`` that are one edit apart, once.

    Words have at least four letters. There are as many rounds as a path has nodes, so logarithmically many
    for usual vocabularies; each reads the edges of one level and the states that have come there, and writes the
    next ones to the shared folder.
    """
    edges, begun = trie(words)
    edges, begun = _stored_by_level(edges, "edges"), _stored_by_level(begun, "states")
    deepest = edges.agg(F.max("level")).first()[0]
    frontier, moved = None, []
    for level in range(0 if deepest is None else deepest + 1):
        here = begun.where(F.col("level") == level).select(
            "word", "back", "node", "position", F.lit(0).alias("edits"), F.lit(None).cast("string").alias("near")
        )
        if frontier is not None:
            here = here.unionByName(frontier)
        moved.append(settle(_advanced(here, edges.where(F.col("level") == level)), "frontier"))
        frontier = moved[-1].where("child is not null").withColumnRenamed("child", "node").drop("ends")
    if not moved:
        return words.select("word", F.col("word").alias("near")).where("false")
    done = moved[0]
    for other in moved[1:]:
        done = done.unionByName(other)
    done = done.where("edits = 1 and ends and position = length(word)")
    turned = [F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)).alias(c) for c in ("word", "near")]
    # Both tries meet an insertion beside an equal letter; the backward one leaves it to the other.
    half = F.expr("cast(length(word) / 2 as int)")
    twice = F.col("back") & (F.left("word", half) == F.left("near", half))
    return done.select("back", *turned).where(~twice).select("word", "near")


def _last_forms(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form: the last one, by following twice as many forms a round."""
    roots = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settle(
            roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("on")),
            "roots",
        )
        roots = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return roots


def variants(words: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for words with counts ``(word, n)``.

    The form is the most frequent near word, the first in code-point order among equals, if it is at least
    twice as frequent; forms of forms end at the root. Words must be distinct and of at least four letters;
    no words give no rows, and other columns are not kept.
    """
    words = settle(words.select("word", "n"), "words")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = settle(near_words(words).join(known, "near").join(words, "word"), "pairs")
    both = pairs.select("word", "n", "near", "near_n").union(pairs.select("near", "near_n", "word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("rare"), F.col("near").alias("form"))).alias("best")
    summed = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    frequent = -F.col("best.rare") >= 2 * F.col("n")
    named = settle(
        words.join(summed, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.form")).alias("form"),
            F.when(frequent, -F.col("best.rare")).alias("form_n"),
        ),
        "forms",
    )
    roots = _last_forms(named.where("form is not null"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_trie_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
