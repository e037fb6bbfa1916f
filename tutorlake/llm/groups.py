"""Links within groups, without pairs: what is near each other in a group, directly or over others.

A group's task walks from one member to those near it that it has not met yet, so a group of copies costs its size
and not its square, and returns one link for every member met. Large groups are cut into tiles of bounded size, of which
all meet the first; what then is not part of the group's main class meets all other tiles. The outcome is that of
comparing all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.llm.components import components
from tutorlake.llm.shingles import shingles
from tutorlake.sources.tables import settle

# Similarity as a fraction.
SIMILAR = (4, 5)
# Bytes of sets in a cloud that one tile holds.
TILE_BYTES = 8_000_000
# Bits of the filter that keeps texts of no cloud from being shuffled; 1 MB whatever the input.
FILTER_BITS = 1 << 23
# Tells which of the members numbered ``others`` are close to member ``one``.
Near = Callable[[int, np.ndarray], np.ndarray]


def sizes_fit(one: int, others: np.ndarray) -> np.ndarray:
    return SIMILAR[1] * np.minimum(others, one) >= SIMILAR[0] * np.maximum(others, one)


def sets_near(sizes: np.ndarray, marks: list[bytes]) -> Near:
    """Exact: counts of shared shingles, over the shingles' numbers within the group."""
    _, numbers = np.unique(np.frombuffer(b"".join(marks), np.uint64), return_inverse=True)
    ends = np.cumsum(sizes)
    member = np.zeros(int(numbers.max(initial=0)) + 1, bool)

    def near(one: int, others: np.ndarray) -> np.ndarray:
        own = numbers[ends[one] - sizes[one] : ends[one]]
        member[own] = True
        if 2 * len(others) > len(sizes):
            shared = np.add.reduceat(member[numbers], ends - sizes)[others]
        else:
            shared = np.array([np.count_nonzero(member[numbers[ends[k] - sizes[k] : ends[k]]]) for k in others], np.int64)
        member[own] = False
        return SIMILAR[1] * shared >= SIMILAR[0] * (sizes[one] + sizes[others] - shared)

    return near


def walk(count: int, near: Near) -> list[list[int]]:
    """Classes of two members or more that are near each other, directly or over others; each member is met once."""
    classes = []
    unmet = np.arange(count)
    while len(unmet) > 1:
        own, unmet = [int(unmet[0])], unmet[1:]
        open_ = list(own)
        while open_ and len(unmet):
            found = near(open_.pop(), unmet)
            met = unmet[found].tolist()
            own += met
            open_ += met
            unmet = unmet[~found]
        if len(own) > 1:
            classes.append(own)
    return classes


def bridges(strays: np.ndarray, roots: list, near: Near) -> list[tuple[int, int]]:
    """Steps from members marked in ``strays`` to members of other roots, one for each two roots that meet."""
    _, labels = np.unique(np.array(roots), return_inverse=True)
    steps = []
    for one in np.nonzero(strays)[0].tolist():
        others = np.nonzero(labels != labels[one])[0]
        if not len(others):
            break
        for k in others[near(one, others)].tolist():
            if labels[k] != labels[one]:
                labels[labels == labels[k]] = labels[one]
                steps.append((one, k))
    return steps


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one value of the first two columns after another, of sorted rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        group, turn = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        cuts = (np.nonzero((group[1:] != group[:-1]) | (turn[1:] != turn[:-1]))[0] + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            if held and (group[a], turn[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = (group[a], turn[a])
    if held:
        yield pa.Table.from_batches(held)


def _steps(dealt: DataFrame, measure: Callable[[np.ndarray, list[bytes]], Near], rooted: bool = False) -> DataFrame:
    """``(left, right)`` of rows ``(group, turn, node, n, mark)``, with ``(stray, root)`` if ``rooted``."""
    kind = dealt.schema["node"].dataType
    schema = T.StructType([T.StructField("left", kind), T.StructField("right", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(left, nodes_type), pa.array(right, nodes_type)], names=["left", "right"])
            left.clear()
            right.clear()
            return made

        left, right, nodes_type = [], [], pa.int64()
        for table in _by_group(batches):
            if len(table) < 2:
                continue
            nodes_type = table.schema.field("node").type
            nodes = table["node"].to_pylist()
            near = measure(table["n"].to_numpy(), table["mark"].to_pylist())
            if rooted:
                found = bridges(table["stray"].to_numpy(zero_copy_only=False), table["root"].to_pylist(), near)
                pairs = {(nodes[a], nodes[b]) for a, b in found}
            else:
                # All members of a class by way of its least node, so that many groups give few different links.
                members = [{nodes[k] for k in own} for own in walk(len(nodes), near)]
                pairs = {(min(own), node) for own in members for node in own}
            for a, b in pairs:
                if a != b:
                    left.append(a)
                    right.append(b)
            if len(left) > 50_000:
                yield flush()
        yield flush()

    return dealt.repartition("group", "turn").sortWithinPartitions("group", "turn").mapInArrow(run, schema)


def linked(
    rows: DataFrame, measure: Callable[[np.ndarray, list[bytes]], Near], limit: int, any_large: bool, name: str
) -> DataFrame:
    """Links ``(left, right)`` that join all nodes of a group that are near, directly or over others of the group.

    ``rows`` are ``(group, size, node, n, mark)``; ``size`` is the group's, ``limit`` what a tile holds of it, and
    ``any_large`` says whether there is a group beyond that.
    """
    if any_large:
        rows = settle(rows, "members")
    tiles = F.greatest(F.lit(1), F.ceil(F.col("size") / limit)).cast("int")
    placed = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node", "group"), F.col("tiles")).cast("int"))
    first = (F.col("tiles") > 1) & (F.col("tile") == 0)
    turns = F.when(first, F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("tiles") - 1))).otherwise(F.array("tile"))
    dealt = placed.select("group", F.explode(turns).alias("turn"), "node", "n", "mark")
    links = settle(_steps(dealt, measure).distinct(), name)
    if not any_large:
        return links
    large = placed.where("tiles > 1")
    reached = components(links, "left", "right").toDF("__node", "root")
    large = settle(
        large.join(reached, F.col("node") == F.col("__node"), "left").withColumn("root", F.coalesce("root", "node")).drop("__node"), "large"
    )
    shares = large.groupBy("group", "root").agg(F.count(F.lit(1)).alias("share"))
    main = shares.groupBy("group").agg(F.max(F.struct("share", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("roots"))
    main = main.where("roots > 1").select(F.col("group").alias("g"), "main")
    known = large.join(main, F.col("group") == F.col("g")).drop("g")
    strays = known.where("root <> main")
    counts = strays.groupBy("group").agg(F.count(F.lit(1)).alias("strays"))
    totals = known.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    # Strays take as many tiles as their share of the group.
    parts = F.greatest(F.lit(1), F.ceil(F.col("tiles") * F.col("strays") / F.col("members"))).cast("int")
    share = counts.join(totals, "group").select(F.col("group").alias("g"), "strays", "members")
    known = known.join(share, F.col("group") == F.col("g")).drop("g").withColumn("parts", parts)
    part = F.pmod(F.xxhash64("group", "node"), F.col("parts")).cast("int")
    carried = ["node", "n", "mark", "root"]
    sides = known.where("root <> main").select(
        "group", F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda m: part * F.col("tiles") + m)).alias("turn"),
        *carried, F.lit(True).alias("stray"),
    ).union(
        known.select(
            "group", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda s: s * F.col("tiles") + F.col("tile"))).alias("turn"),
            *carried, F.lit(False).alias("stray"),
        )
    )
    return links.union(_steps(sides, measure, rooted=True)).distinct()


def _word(column: str) -> F.Column:
    return F.shiftright(F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)), 6)


def _bit(column: str) -> F.Column:
    return F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), 64) as int))")


def _words(wanted: DataFrame, name: str) -> DataFrame:
    """The words of a filter of one hash and ``FILTER_BITS`` bits over the values of ``name``."""
    return wanted.groupBy(_word(name).alias("__word")).agg(F.bit_or(_bit(name)).alias("__bits"))


def possible(documents: DataFrame, wanted: DataFrame, key: str, name: str) -> DataFrame:
    """The rows of ``documents`` whose key may be among ``wanted``: all that are, and a few others.

    A filter of one hash and ``FILTER_BITS`` bits, joined as at most ``FILTER_BITS / 64`` rows, so it may be
    broadcast whatever the input. It saves shuffling the texts of all other documents; beyond some million keys it
    keeps most rows, and what follows is as right without it.
    """
    met = documents.join(F.broadcast(_words(wanted, name)), _word(key) == F.col("__word"))
    return met.where(F.col("__bits").bitwiseAND(_bit(key)) != 0).drop("__word", "__bits")


def without(documents: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``documents`` whose key is not among the keys of ``gone``; rows without a key stay.

    Rows that the filter of :func:`possible` lets through are kept where they stand, so that only the texts of those that
    may go are shuffled and sorted.
    """
    met = documents.join(F.broadcast(_words(gone, key)), _word(key) == F.col("__word"), "left")
    met = met.withColumn("__maybe", F.coalesce(F.col("__bits").bitwiseAND(_bit(key)) != 0, F.lit(False)))
    sure = met.where(~F.col("__maybe")).select(*documents.columns)
    return sure.union(met.where("__maybe").select(*documents.columns).join(gone.select(key), key, "left_anti").select(*documents.columns))


def confirmed(links: DataFrame, nodes: DataFrame, documents: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """Links that join the documents of each cloud of candidates ``(left, right)`` whose full sets are similar enough.

    ``nodes`` has each ``node``, a key of ``documents``, with its set's size ``n``.
    """
    clouds = components(links, "left", "right").toDF("node", "group")
    own_sizes = nodes.groupBy("node").agg((F.sum("n") * 8).alias("own"))
    clouds = settle(clouds.join(own_sizes, "node"), "clouds")
    sizes = settle(clouds.groupBy("group").agg(F.sum("own").alias("size")), "sizes")
    members = clouds.join(sizes, "group").select("node", "group", "size")
    kind = documents.schema[key].dataType
    kinds = [("group", kind), ("size", T.LongType()), ("node", kind), ("n", T.LongType()), ("mark", T.BinaryType())]
    schema = T.StructType([T.StructField(*k) for k in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x.as_py(), shingle) for x in batch.column(3)]
            columns = [pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=schema.names)

    texts = documents.select(F.col(key).alias("node"), F.col(text).cast("binary").alias("body"))
    own = possible(texts, clouds, "node", "node").join(members, "node").select("group", "size", "node", "body")
    sets = own.mapInArrow(run, schema).where("n > 0")
    return linked(sets, sets_near, TILE_BYTES, not sizes.where(F.col("size") > TILE_BYTES).isEmpty(), "similar")
