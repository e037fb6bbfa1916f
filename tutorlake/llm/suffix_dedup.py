"""Removal of bytes covered by long strings that occur elsewhere, judged by suffix arrays.

A string of ``length`` bytes starting at every place of a text is a window. Windows that may repeat are
dealt to buckets by a long part that they share, and a suffix array over a bucket's text, made by
two-stage sorting, with the common prefixes of neighbours shows which windows are equal.

1.  The smallest hash of the 64-byte strings in a window is its anchor. Equal windows have equal anchors
    at the same place, so windows whose anchor occurs once need no further look.
2.  The windows of an anchor are taken in blocks of 64 starts. All windows of a block contain its core;
    the block's whole text is its hull. Only blocks that share their core can hold equal windows.
    Equal hulls are sorted once, as one string that is there several times.
3.  The distinct hulls of a core go to one bucket, of bounded size. A core with more than ``HULLS``
    hulls, a passage in very many texts for instance, is split further, by parts of a few windows, then single ones.

Every step is a shuffle by content with sums before it, so copies in any number meet as counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.sources.tables import drop_folder, settle, stored_paths

LENGTH = 400
GRAM = 64
BLOCK = 64
HULLS = 1024
BUCKET_BYTES = 400_000
PART = 8
STRETCH = 1 << 19
END = 0xFF  # never part of UTF-8 text
_MULTIPLIER = 0x9E3779B97F4A7C15


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; a run of one byte is as what follows it decides."""
    size = len(text)
    changes = np.append(np.nonzero(text[:-1] != text[1:])[0], size - 1)
    change = changes[np.searchsorted(changes, np.arange(size))]
    return np.append(text, 0)[change] < np.append(text, -1)[change + 1]


def suffix_array(text: bytes, depth: int = LENGTH) -> np.ndarray:
    """The starts of all suffixes, in order of their first ``depth`` bytes, by two-stage sorting.

    Only suffixes smaller than their successors are compared with each other. A scan over the buckets of
    first bytes, in order, then gives every other suffix its place behind the suffix it precedes.
    """
    size = len(text)
    letters = np.frombuffer(text, np.uint8).astype(np.int16)
    if not size:
        return np.zeros(0, np.int64)
    rising = types(letters)
    ordered = sorted(np.nonzero(rising)[0].tolist(), key=lambda k: text[k : k + depth])
    sizes = np.bincount(letters, minlength=256)
    sorted_sizes = np.bincount(letters[rising], minlength=256)
    ends = np.cumsum(sizes)
    array = np.full(size, -1, np.int64)
    done = 0
    for c in np.nonzero(sorted_sizes)[0]:
        array[ends[c] - sorted_sizes[c] : ends[c]] = ordered[done : done + sorted_sizes[c]]
        done += sorted_sizes[c]
    front = ends - sizes
    array[front[letters[-1]]] = size - 1
    front[letters[-1]] += 1

    def induce(suffixes: np.ndarray) -> None:
        before = suffixes[suffixes > 0] - 1
        before = before[~rising[before]]
        first = letters[before]
        before = before[np.argsort(first, kind="stable")]
        counts = np.bincount(first, minlength=256)
        used = np.nonzero(counts)[0]
        at = 0
        for c in used:
            array[front[c] : front[c] + counts[c]] = before[at : at + counts[c]]
            front[c] += counts[c]
            at += counts[c]

    for c in np.nonzero(sizes)[0]:
        at = ends[c] - sizes[c]
        while at < front[c]:
            until = front[c]
            induce(array[at:until])
            at = until
        induce(array[ends[c] - sorted_sizes[c] : ends[c]])
    return array


def common_prefixes(text: bytes, left: np.ndarray, right: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """How many bytes the suffixes at ``left`` and ``right`` share, up to ``depth``, eight at a time."""
    padded = np.frombuffer(text + bytes(depth + 8), np.uint8)
    words = np.lib.stride_tricks.as_strided(padded, (len(text) + depth, 8), (1, 1))
    shared = np.full(len(left), depth, np.int64)
    open_ = np.arange(len(left))
    for at in range(0, depth, 8):
        same = words[left[open_] + at] == words[right[open_] + at]
        stop = ~same.all(axis=1)
        shared[open_[stop]] = np.minimum(depth, at + np.argmin(same[stop], axis=1))
        open_ = open_[~stop]
        if not len(open_):
            break
    return shared


def repeated_windows(hulls: list[bytes], places: np.ndarray, times: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Per hull the starts, from 0, of windows that occur elsewhere.

    ``places`` numbers the first byte of each hull over all texts: the same window of the same text, seen in
    two hulls, is one place. A hull that occurs ``times`` > 1 makes all its windows occur elsewhere.
    """
    text = bytes([END]).join(hulls) + bytes([END])
    sizes = np.array([len(h) for h in hulls])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    owner = np.repeat(np.arange(len(hulls)), sizes + 1)
    inside = np.arange(len(text)) - begins[owner]
    array = suffix_array(text, length)
    array = array[inside[array] + length <= sizes[owner[array]]]
    if not len(array):
        return [np.zeros(0, np.int64)] * len(hulls)
    prefix = common_prefixes(text, array[:-1], array[1:], length)
    group = np.concatenate([[0], np.cumsum(prefix < length)])
    starts = np.nonzero(np.concatenate([[True], prefix < length]))[0]
    place = places[owner[array]] + inside[array]
    several = np.minimum.reduceat(place, starts) != np.maximum.reduceat(place, starts)
    several |= np.maximum.reduceat(times[owner[array]], starts) > 1
    found = array[several[group]]
    order = np.argsort(found)
    found = found[order]
    return [inside[found[a:b]] for a, b in zip(*_bounds(owner[found], len(hulls)), strict=True)]


def _bounds(sorted_owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    return np.searchsorted(sorted_owner, np.arange(count)), np.searchsorted(sorted_owner, np.arange(count), side="right")


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    ups, downs = np.ones(count, np.uint64), np.ones(count, np.uint64)
    ups[1:] = _MULTIPLIER
    downs[1:] = pow(_MULTIPLIER, -1, 1 << 64)
    return np.cumprod(ups, dtype=np.uint64), np.cumprod(downs, dtype=np.uint64)


class Anchors:
    """Finds the anchor of every window; works through a text in stretches of ``STRETCH`` starts."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM) -> None:
        self.length, self.gram = length, gram
        self.reach = length - gram + 1
        self.ups, self.downs = _powers(STRETCH + length + 1)

    def hashes(self, part: np.ndarray) -> np.ndarray:
        terms = (part.astype(np.uint64) + np.uint64(1)) * self.ups[: len(part)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        value = (sums[self.gram :] - sums[: -self.gram]) * self.downs[: len(part) - self.gram + 1]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ value >> np.uint64(32)

    def least(self, values: np.ndarray) -> np.ndarray:
        """The minimum of every ``reach`` neighbouring values, from minima to both ends of fixed cells."""
        reach, size = self.reach, len(values)
        padded = np.full(-(-size // reach) * reach, np.iinfo(np.uint64).max, np.uint64)
        padded[:size] = values
        cells = padded.reshape(-1, reach)
        up = np.minimum.accumulate(cells, axis=1).ravel()
        down = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(down[: size - reach + 1], up[reach - 1 : size])

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """``(anchor, hash)`` for every window start; the leftmost of equal smallest hashes is the anchor."""
        whole = np.frombuffer(text, np.uint8)
        anchors, marks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        mask = np.uint64((1 << 20) - 1)
        for at in range(0, len(text) - self.length + 1, STRETCH):
            values = self.hashes(whole[at : at + STRETCH + self.length - 1])
            keys = values & ~mask | np.arange(len(values), dtype=np.uint64)
            where = (self.least(keys) & mask).astype(np.int64)
            anchors.append(where + at)
            marks.append(values[where])
        return np.concatenate(anchors), np.concatenate(marks)

    def blocks(self, text: bytes, repeated: np.ndarray) -> list[tuple[int, int, bytes, bytes]]:
        """``(start, end, core, hull)`` of the blocks of windows with a repeated anchor; the last two as digests."""
        anchors, _ = self.of(text)
        starts = np.nonzero(np.isin(anchors, repeated))[0]
        if not len(starts):
            return []
        anchor = anchors[starts]
        block = (anchor - starts) // BLOCK
        fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])])
        found = []
        for a, b in zip(anchor[fresh].tolist(), block[fresh].tolist(), strict=True):
            last = a - BLOCK * b
            first = last - BLOCK + 1
            begin, end = max(0, first), min(len(text), last + self.length)
            core = xxhash.xxh3_128_digest(text[last : first + self.length])
            found.append((begin, end, core, xxhash.xxh3_128_digest(text[begin:end])))
        return found


def spans_of(intervals: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows that start in the closed intervals."""
    runs: list[list[int]] = []
    for first, last in sorted(intervals):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + length)
        else:
            runs.append([first, last + length])
    return [(a, b) for a, b in runs]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Closed intervals of consecutive numbers in ascending order."""
    if not len(starts):
        return []
    breaks = np.nonzero(np.diff(starts) > 1)[0]
    return list(zip(starts[np.append(0, breaks + 1)].tolist(), starts[np.append(breaks, len(starts) - 1)].tolist(), strict=True))


def _expand(rows: DataFrame, lists: list[str], schema: str, work) -> DataFrame:
    """``mapInArrow`` that yields, for each input row, the rows of ``work``; column ``id`` is repeated."""
    kind = rows.schema["id"].dataType
    full = T.StructType([T.StructField("id", kind), *T._parse_datatype_string(schema).fields])
    names = [f.name for f in full.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = work()
        for batch in batches:
            row, made = [], []
            ids = batch.column(0)

            def flush(row=row, made=made, ids=ids):
                columns = list(zip(*made, strict=True)) or [()] * (len(names) - 1)
                return pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types_, strict=True))],
                    names=names,
                )

            for k, values in enumerate(zip(*(batch.column(i + 1).to_pylist() for i in range(len(lists))), strict=True)):
                for found in task(*values):
                    row.append(k)
                    made.append(found)
                if len(made) > 100_000:
                    yield flush()
                    row.clear()
                    made.clear()
            yield flush()

    from pyspark.sql.pandas.types import to_arrow_type

    types_ = [to_arrow_type(f.dataType) for f in full.fields[1:]]
    return rows.select("id", *lists).mapInArrow(run, full)


def repeated_starts(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(id, text, starts)``: of every text with repeated windows the intervals of their starts.

    ``documents`` has ``id`` and ``text`` as bytes. Rows of equal ``id`` must have equal text; they are
    separate texts, which repeat each other, and give a row each.
    """

    def anchors():
        finder = Anchors(length)

        def find(text: bytes | None):
            where, marks = finder.of(text or b"")
            fresh = np.concatenate([[True], where[1:] != where[:-1]]) if len(where) else np.zeros(0, bool)
            return zip(marks[fresh].view(np.int64).tolist(), where[fresh].tolist(), strict=True)

        return find

    with stored_paths() as read_once:
        marked = settle(_expand(documents, ["text"], "mark long, place int", anchors), "anchors")
    often = marked.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    # Stored, so that both sides of the join come from plain shuffles and a hot mark can be split.
    often = settle(often, "often")
    candidates = marked.join(often, "mark").groupBy("id").agg(F.collect_set("place").alias("places"))
    texts = settle(documents.join(candidates, "id"), "candidates")
    for path in read_once:
        drop_folder(documents.sparkSession, path)

    def blocks():
        finder = Anchors(length)
        return lambda text, places: finder.blocks(text or b"", np.array(places))

    cut = settle(_expand(texts, ["text", "places"], "start int, end int, core binary, hull binary", blocks), "blocks")
    row = F.struct("id", "start", "end")
    # Two anchors of a text may give one block: what counts is whether a hull stands at several places.
    several = F.when(F.min(row) == F.max(row), 1).otherwise(2).cast("long")
    hulls = cut.groupBy("core", "hull").agg(several.alias("times"), F.min(row).alias("one"))
    hulls = settle(hulls, "hulls")
    shared = hulls.groupBy("core").agg(F.count(F.lit(1)).alias("hulls"), F.min("times").alias("rarest"))
    shared = shared.where("hulls > 1 and rarest = 1")
    open_ = hulls.join(shared, "core").select(
        F.col("one.id").alias("id"), "one.start", "one.end", "core", "times", "hulls"
    )
    wanted = open_.groupBy("id").agg(F.collect_list(F.struct("start", "end", "core", "times", "hulls")).alias("wanted"))

    def pieces():
        return lambda text, wanted: (
            (w["start"], w["core"], w["times"], w["hulls"], text[w["start"] : w["end"]]) for w in wanted
        )

    dealt = settle(
        _expand(texts.dropDuplicates(["id"]).join(wanted, "id"), ["text", "wanted"],
                "start int, core binary, times long, hulls long, piece binary", pieces), "pieces"
    )
    met = _sorted_buckets(dealt.where(F.col("hulls") <= HULLS), length).union(
        _single_windows(dealt.where(F.col("hulls") > HULLS), length)
    )
    copied = hulls.where("times > 1").select(F.col("core").alias("c"), F.col("hull").alias("h"))
    whole = cut.join(copied, (F.col("core") == F.col("c")) & (F.col("hull") == F.col("h"))).select(
        "id", F.col("start").alias("first"), (F.col("end") - length).cast("int").alias("last")
    )
    listed_twice = (
        texts.groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.octet_length("text")).alias("size"))
        .where("n > 1")
        .select("id", F.lit(0).alias("first"), (F.col("size") - length).alias("last"))
    )
    found = whole.union(met).union(listed_twice).groupBy("id").agg(F.collect_set(F.struct("first", "last")).alias("starts"))
    return texts.select("id", "text").join(found, "id")


def _sorted_buckets(dealt: DataFrame, length: int) -> DataFrame:
    """Repeated windows of pieces that occur once, by suffix arrays over buckets of whole cores."""
    size = dealt.agg(F.sum(F.octet_length("piece")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    schema = T.StructType(
        [dealt.schema["id"], T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["id"].to_pylist()
        numbers: dict = {}
        owners = np.array([numbers.setdefault(str(x), len(numbers)) for x in ids], np.int64)
        starts = table["start"].to_numpy().astype(np.int64)
        times = table["times"].to_numpy()
        found = repeated_windows(table["piece"].to_pylist(), (owners << 32) + starts, times, length)
        row, first, last = [], [], []
        for k, own in enumerate(found):
            if times[k] == 1:
                for a, b in _runs(own + starts[k]):
                    row.append(k)
                    first.append(a)
                    last.append(b)
        taken = table["id"].take(pa.array(row, pa.int64()))
        return pa.table([taken, pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=["id", "first", "last"])

    keyed = dealt.withColumn("bucket", F.pmod(F.xxhash64("core"), F.lit(buckets)))
    return keyed.select("bucket", "id", "start", "times", "piece").groupBy("bucket").applyInArrow(run, schema)


def _single_windows(dealt: DataFrame, length: int) -> DataFrame:
    """Repeated windows of pieces that occur once, for cores with very many hulls.

    Pieces are cut into parts of ``PART`` windows. Parts that are equal stand for all their windows at once; of
    different parts one each is then cut into windows, so a passage in very many texts gives few rows a text.
    """

    def parts():
        def cut(start, times, piece):
            last = len(piece) - length
            for k in range(0, last + 1, PART):
                body = piece[k : min(k + PART - 1, last) + length]
                yield start + k, times, xxhash.xxh3_128_digest(body), body

        return cut

    def windows():
        def cut(start, times, body):
            for k in range(len(body) - length + 1):
                yield start + k, times, xxhash.xxh3_128_digest(body[k : k + length])

        return cut

    at = F.struct("id", "place")
    seen = [F.min(at).alias("a"), F.max(at).alias("b"), F.max("times").alias("most")]
    several = (F.col("a") != F.col("b")) | (F.col("most") > 1)
    whole = settle(_expand(dealt, ["start", "times", "piece"], "place int, times long, part binary, body binary", parts), "parts")
    distinct = settle(whole.groupBy("part").agg(*seen, F.first("body").alias("body")), "distinct")
    equal = distinct.where(several).select(F.col("part").alias("p"))
    last = (F.col("place") + F.octet_length("body") - length).cast("int")
    met = whole.where("times = 1").join(equal, F.col("part") == F.col("p")).select("id", F.col("place").alias("first"), last.alias("last"))

    ones = distinct.select(
        F.col("a.id").alias("id"), F.col("a.place").alias("place"), F.when(several, 2).otherwise(1).cast("long").alias("times"), "body"
    )
    single = settle(_expand(ones, ["place", "times", "body"], "place int, times long, window binary", windows), "windows")
    again = single.groupBy("window").agg(*seen).where(several).select(F.col("window").alias("w"))
    hit = single.where("times = 1").join(again, F.col("window") == F.col("w"))
    return met.union(hit.select("id", F.col("place").alias("first"), F.col("place").alias("last")))


def _identified(documents: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return documents.select(F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark")).alias("id"), body.alias("text"))


def removals(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(id, n_removed, n_spans, kept)`` of every text that loses bytes; ``kept`` are the bytes that stay."""

    def cut():
        def work(body, starts):
            runs = spans_of([(s["first"], s["last"]) for s in starts], length)
            kept, at = [], 0
            for a, b in runs:
                kept.append(body[at:a])
                at = b
            return [(sum(b - a for a, b in runs), len(runs), b"".join([*kept, body[at:]]))]

        return work

    found = repeated_starts(_identified(documents, key, text), length)
    return _expand(found, ["text", "starts"], "n_removed long, n_spans long, kept binary", cut)


def without_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All rows and columns, with repeated strings cut out of the texts.

    A character of which a byte is cut goes as a whole. Texts without repeats, null ones too, stay as they are.
    """
    kept = removals(documents, key, text, length).select(F.col("id").alias("__id"), F.col("kept").alias("__kept"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py().decode("utf-8", "ignore") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["__id", "__kept"])

    kind = T.StructType([kept.schema["__id"], T.StructField("__kept", T.StringType())])
    cut = kept.dropDuplicates(["__id"]).mapInArrow(whole, kind)
    own = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("mark"))
    return (
        documents.withColumn("__own", own)
        .join(cut, F.col("__own") == F.col("__id"), "left")
        .withColumn(text, F.coalesce("__kept", text))
        .select(*documents.columns)
    )


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 400 bytes that occur elsewhere; null texts count as empty."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lost = removals(documents).select("id", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha")).dropDuplicates(["id"])
    body = F.coalesce("text", F.lit("")).cast("binary")
    return (
        documents.select(
            "doc_id",
            F.octet_length(body).cast("long").alias("n_bytes"),
            F.sha2(body, 256).alias("sha"),
            F.struct(F.col("doc_id").alias("key"), F.xxhash64("text").alias("mark")).alias("id"),
        )
        .join(lost, "id", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
            F.coalesce("kept_sha", "sha").alias("kept_sha256"),
        )
    )
