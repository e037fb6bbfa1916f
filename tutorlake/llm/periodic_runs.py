"""Periodic runs of words inside a text: stretches that repeat a block of words several times over.

A run has smallest period ``q`` (words ``q`` apart are equal), at least ``max(LEAST, TIMES * q)`` words, and no
neighbouring word extends it. Runs are found on a harmonic grid: for every period ``p`` the places
``0, 2p, 4p, ...`` are tried, since a run of four periods holds one of them among its first ``2p`` words, and
from there the words and those ``p`` further on agree for at least ``p + 1`` words. How far two places agree is a
longest common extension, answered by a difference cover: only suffixes at places of the cover modulo 13
are sorted; two places compare at most 12 words until both stand in the cover, and from there the least
common prefix between their ranks, from a sparse table, is the answer.

Several texts are worked on at once, as one row of numbers with a sign of its own behind every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST = 6
TIMES = 4
# Words worked on together, and pairs of places tried together; they bound memory and change no result.
TOGETHER = 200_000
TRIED = 2_000_000
# A difference cover; every difference modulo 13 is one of two of these.
MODULUS = 13
COVER = (0, 1, 3, 9)


def shifts() -> np.ndarray:
    """The least step that takes two places, by their rests modulo 13, both into the cover."""
    table = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            table[a, b] = next(d for d in range(MODULUS) if (a + d) % MODULUS in COVER and (b + d) % MODULUS in COVER)
    return table


class CommonExtensions:
    """How many numbers two suffixes share. ``text`` holds numbers above 0, the last one only once."""

    def __init__(self, text: np.ndarray) -> None:
        self.size = len(text)
        self.text = np.concatenate([text, np.zeros(2 * MODULUS, np.int64)])
        self.shifts = shifts()
        member = np.isin(np.arange(self.size) % MODULUS, COVER)
        self.places = np.nonzero(member)[0]
        self.number = np.cumsum(member) - 1
        order, levels = self._sorted()
        self.rank = levels[-1]
        self.table = self._minima(self._neighbours(order, levels))

    def _sorted(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sampled suffixes in order; ranks by the first 13, 26, 52, ... numbers until all differ.

        A place 13 further on is in the cover too, so ranks double as in a suffix array of all places. Only
        suffixes that are still equal to another are sorted again.
        """
        size = len(self.places)
        bits = max(1, int(self.text.max()).bit_length())
        per = max(1, 63 // bits)
        keys = []
        for at in range(0, MODULUS, per):
            key = self.text[self.places + at]
            for k in range(at + 1, min(at + per, MODULUS)):
                key = key << bits | self.text[self.places + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        fresh = np.zeros(size, bool)
        fresh[:1] = True
        for key in keys:
            ordered = key[order]
            fresh[1:] |= ordered[1:] != ordered[:-1]
        levels = [self._ranks(order, fresh)]
        step = MODULUS
        while True:
            slots = np.nonzero(~(fresh & np.append(fresh[1:], True)))[0]
            if not len(slots):
                return order, levels
            open_ = order[slots]
            ahead = self.places[open_] + step
            following = np.where(ahead < self.size, levels[-1][self.number[np.minimum(ahead, self.size - 1)]], -1)
            again = np.lexsort((following, levels[-1][open_]))
            order[slots] = open_[again]
            following = following[again]
            fresh[slots[1:]] |= following[1:] != following[:-1]
            levels.append(self._ranks(order, fresh))
            step *= 2

    @staticmethod
    def _ranks(order: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
        return rank

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of neighbours in the order, by equal ranks from the longest step down."""
        left, right = self.places[order[:-1]].copy(), self.places[order[1:]].copy()
        shared = np.zeros(len(left), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.maximum(left, right) < self.size
            a, b = self.number[np.where(inside, left, 0)], self.number[np.where(inside, right, 0)]
            step = (inside & (levels[k][a] == levels[k][b])) * (MODULUS << k)
            shared += step
            left += step
            right += step
        return shared + self._words(left, right, np.full(len(left), MODULUS))[0]

    def _words(self, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal numbers from both places on, up to ``most``, and whether all of them are equal."""
        shared, same = np.zeros(len(left), np.int64), np.ones(len(left), bool)
        for k in range(int(most.max(initial=0))):
            tried = np.nonzero(same & (most > k))[0]
            if not len(tried):
                break
            equal = self.text[left[tried] + k] == self.text[right[tried] + k]
            shared[tried] += equal
            same[tried] = equal
        return shared, same

    @staticmethod
    def _minima(shared: np.ndarray) -> np.ndarray:
        rows = [shared]
        width = 1
        while 2 * width <= len(shared):
            row = rows[-1].copy()
            row[: len(row) - width] = np.minimum(row[: len(row) - width], row[width:])
            rows.append(row)
            width *= 2
        return np.stack(rows)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Shared numbers of the suffixes at ``left`` and at ``right``, which lies behind it in the same text."""
        shift = self.shifts[left % MODULUS, right % MODULUS]
        shared, same = self._words(left, right, shift)
        on = np.nonzero(same)[0]
        a = self.rank[self.number[left[on] + shift[on]]]
        b = self.rank[self.number[right[on] + shift[on]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        shared[on] += np.minimum(self.table[level, low], self.table[level, high - (1 << level.astype(np.int64))])
        return shared


def _grid(begins: np.ndarray, sizes: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(begin, place, period)`` of the places to try, in portions: every second multiple of every period."""
    periods = sizes // times
    owner = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    counts = (sizes[owner] - 2 * period - 1) // (2 * period) + 1
    cuts = np.nonzero(np.diff(np.cumsum(counts) // TRIED))[0] + 1
    for part in np.split(np.arange(len(owner)), cuts):
        number = counts[part]
        row = np.repeat(part, number)
        turn = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
        begin = begins[owner[row]]
        yield begin, begin + turn * 2 * period[row], period[row]


def find_runs(text: np.ndarray, begins: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """All runs as rows ``(start, end, period)`` in order, over texts that begin at ``begins`` of ``text``.

    Behind every text stands a number that occurs once. ``times`` is 4 or more.
    """
    extensions = None
    found = [np.zeros((0, 4), np.int64)]
    for begin, place, period in _grid(begins, sizes, times):
        alike = np.nonzero(text[place] == text[place + period])[0]
        alike = alike[text[place[alike] + 1] == text[place[alike] + period[alike] + 1]]
        if not len(alike):
            continue
        begin, place, period = begin[alike], place[alike], period[alike]
        if extensions is None:
            extensions = CommonExtensions(text)
        shared = extensions.of(place, place + period)
        far = shared > period
        begin, place, period, end = begin[far], place[far], period[far], (place + period + shared)[far]
        # Stretches of one period with one end are the same: the first place seen stands for all.
        order = np.lexsort((place, period, end))
        first = np.ones(len(order), bool)
        first[1:] = (end[order][1:] != end[order][:-1]) | (period[order][1:] != period[order][:-1])
        order = order[first]
        found.append(np.stack([begin[order], place[order], period[order], end[order]], axis=1))
    begin, place, period, end = np.concatenate(found).T
    low, high = begin.copy(), place.copy()
    while (low < high).any():
        on = np.nonzero(low < high)[0]
        middle = (low[on] + high[on]) // 2
        reaches = extensions.of(middle, middle + period[on]) >= place[on] - middle
        high[on] = np.where(reaches, middle, high[on])
        low[on] = np.where(reaches, low[on], middle + 1)
    long = end - low >= np.maximum(least, times * period)
    runs = np.stack([low[long], end[long], period[long]], axis=1)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # Multiples of a period give the same stretch; the smallest one is its period.
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as numbers from 1, each text followed by a number of its own; begins and sizes of the texts."""
    known: dict[bytes, int] = {}
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    numbers = np.zeros(ends[-1], np.int64)
    for words, end in zip(texts, ends.tolist(), strict=True):
        numbers[end - 1 - len(words) : end - 1] = [known.setdefault(w, len(known) + 1) for w in words]
    numbers[ends - 1] = len(known) + 1 + np.arange(len(texts))
    return numbers, ends - 1 - sizes, sizes


def worked(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[tuple[np.ndarray, bytes]]:
    """Per text its runs ``(start, length, period)`` and the words that stay, joined by one space."""
    numbers, begins, sizes = _numbered(texts)
    runs = find_runs(numbers, begins, sizes, least, times)
    bounds = np.searchsorted(runs[:, 0], np.append(begins, len(numbers)))
    made = []
    for k, words in enumerate(texts):
        own = runs[bounds[k] : bounds[k + 1]] - (begins[k], begins[k], 0)
        if len(own):
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, own[:, 0] + own[:, 2], 1)
            np.add.at(edges, own[:, 1], -1)
            words = [words[i] for i in np.nonzero(np.cumsum(edges[:-1]) == 0)[0].tolist()]
            own = np.stack([own[:, 0], own[:, 1] - own[:, 0], own[:, 2]], axis=1)
        made.append((own, b" ".join(words)))
    return made


def periodic_runs(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    times: int = TIMES,
    change: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``(key, runs, collapsed)``: a row per row of ``documents``, its runs in order, and its text without repeats.

    ``runs`` holds ``(start, length, period)`` in words from 0; ``collapsed`` has all words but those that a run
    holds after its first period. A null or blank text has no words, no runs and an empty ``collapsed``; rows of
    one key and null keys give a row each, and other columns play no part. Nothing is shuffled: a text is worked on
    where it is read, a very long one by itself. ``change`` may replace the words of a row, given its key.
    """
    if times < 4:
        raise ValueError("the grid finds runs of four periods or more")
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType(
        [documents.schema[key], T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]
    )
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def portions(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
        texts: list[list[bytes]] = []
        held = 0
        for n, (name, body) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
            words = (body.as_py() or b"").split()
            if change is not None:
                words = change(name.as_py(), words)
            if texts and held + len(words) > TOGETHER:
                yield n - len(texts), texts
                texts, held = [], 0
            texts.append(words)
            held += len(words)
        if texts:
            yield len(batch) - len(texts), texts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in portions(batch):
                made = worked(texts, least, times)
                flat = np.concatenate([own for own, _ in made])
                offsets = np.concatenate([[0], np.cumsum([len(own) for own, _ in made])]).astype(np.int32)
                values = pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(run_type)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.ListArray.from_arrays(pa.array(offsets), values),
                        pa.array([kept for _, kept in made], pa.binary()).cast(pa.string()),
                    ],
                    names=schema.names,
                )

    return documents.select(key, F.col(text).cast("binary").alias("__text")).mapInArrow(work, schema)


def looped(key: object, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document, by checksum of its id, with a part of them repeated up to the end."""
    if key is None or not words:
        return words
    check = zlib.crc32(str(key).encode())
    if check % 10:
        return words
    g, n = check // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, with parts of some documents repeated as the contract of this query says."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(documents, change=looped)
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
