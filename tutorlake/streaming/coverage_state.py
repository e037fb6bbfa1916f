"""Watched ranges of each learner and video, folded batch by batch.

How much of an event is newly covered depends on everything seen before, so this is the one place where values
are updated by a function of ours. What a batch brings is reduced by Spark first, to one range per second of a video
at most, however often it was watched; the function then works on arrays, never on single events.
The module is sent along with the function, so executors need numpy but no copy of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tutorlake.operators.watching import VIDEO

OUTPUT_SCHEMA = (
    "userid bigint, cwareid bigint, videoid bigint, totaltime bigint, effecttime bigint, completetime bigint, "
    "play_interval string"
)


def join_ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted separate ranges with the same union; touching ranges become one."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.append(True, starts[1:] > ends[:-1])
    closes = np.append(opens[1:], True)
    return starts[opens], ends[closes]


def length_below(starts: np.ndarray, ends: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Covered length of sorted separate ranges below each position."""
    before = np.concatenate([[0], np.cumsum(ends - starts)])
    at = np.searchsorted(starts, positions, side="right")
    beyond = np.maximum(np.append(ends, 0)[at - 1] - positions, 0)
    return before[at] - np.where(at > 0, beyond, 0)


def newly_covered(
    starts: np.ndarray, ends: np.ndarray, ps: np.ndarray, pe: np.ndarray
) -> np.ndarray:
    """What each range, in order of start, adds to the known ranges and to the ones before it."""
    reached = np.concatenate([ps[:1], np.maximum.accumulate(pe)[:-1]])
    low = np.maximum(ps, reached)
    high = np.maximum(pe, low)
    return (high - low) - (length_below(starts, ends, high) - length_below(starts, ends, low))


FOLDED_SCHEMA = f"{OUTPUT_SCHEMA}, updatetime string, starts array<bigint>, ends array<bigint>"


def _lists(column: pa.ListArray) -> tuple[list[np.ndarray], np.ndarray]:
    """The values of a column of lists, field by field where they are structs, and where each list begins and ends."""
    values = column.values
    fields = values.flatten() if pa.types.is_struct(values.type) else [values]
    return [x.to_numpy(zero_copy_only=False) for x in fields], column.offsets.to_numpy()


def folded(
    starts: np.ndarray, ends: np.ndarray, ps: np.ndarray, pe: np.ndarray, elapsed: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Known ranges with a batch of ranges, one per start and in order, and the effective time these add."""
    if not len(ps):
        return starts, ends, 0
    effective = int((elapsed * newly_covered(starts, ends, ps, pe) // (pe - ps)).sum())
    return *join_ranges(np.concatenate([starts, ps]), np.concatenate([ends, pe])), effective


def fold_coverage(fresh: DataFrame, known: DataFrame | None) -> DataFrame:
    """New ranges and times of the videos of a batch, from :func:`batch_coverage` and the values before it.

    A video takes one row, with its ranges as arrays, so a hot one is as long as it has seconds.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    before = ("starts", "array<bigint>"), ("ends", "array<bigint>"), ("totaltime", "bigint"), ("effecttime", "bigint")
    if known is None:
        rows = fresh.select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in before])
    else:
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in VIDEO]
        rows = fresh.join(known.select(*[F.col(k).alias(f"_{k}") for k in VIDEO], *[c for c, _ in before]), same, "left")
    nothing = {"array<bigint>": F.array().cast("array<bigint>"), "bigint": F.lit(0).cast("bigint")}
    filled = [F.coalesce(c, nothing[kind]).alias(c) for c, kind in before]
    rows = rows.select(*VIDEO, "updatetime", "fresh", *filled[:2], (filled[2] + F.col("spent")).alias("totaltime"), filled[3])
    kind = T.StructType.fromDDL(FOLDED_SCHEMA)
    schema = to_arrow_schema(kind)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ps, pe, elapsed), new = _lists(batch.column("fresh"))
            (starts,), old = _lists(batch.column("starts"))
            (ends,), old_ends = _lists(batch.column("ends"))
            made = [
                folded(
                    starts[old[k] : old[k + 1]], ends[old_ends[k] : old_ends[k + 1]],
                    ps[new[k] : new[k + 1]], pe[new[k] : new[k + 1]], elapsed[new[k] : new[k + 1]],
                )
                for k in range(batch.num_rows)
            ]
            offsets = pa.array(np.cumsum([0, *(len(low) for low, _, _ in made)]), pa.int32())
            low, high = (np.concatenate([np.zeros(0, np.int64), *(x[side] for x in made)]) for side in (0, 1))
            columns = {name: batch.column(name) for name in (*VIDEO, "totaltime", "updatetime")} | {
                "effecttime": batch.column("effecttime").to_numpy() + np.array([x[2] for x in made], np.int64),
                "completetime": np.array([(b - a).sum() for a, b, _ in made], np.int64),
                "play_interval": [",".join(f"{a}-{b}" for a, b in zip(x.tolist(), y.tolist(), strict=True)) for x, y, _ in made],
                "starts": pa.ListArray.from_arrays(offsets, pa.array(low)),
                "ends": pa.ListArray.from_arrays(offsets, pa.array(high)),
            }
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x := columns[f.name], pa.Array) and x.type == f.type else pa.array(x, f.type) for f in schema],
                schema=schema,
            )

    return rows.mapInArrow(fold, kind)
