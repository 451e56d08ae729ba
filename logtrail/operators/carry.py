"""Last marked row at or before each row, without one task per key.

A plain window over `keys` sorts each key in a single task, which fails when one
key (or, with no key, the whole table) holds a large share of the rows. Here the
rows of a key are cut twice: into chunks of time, and chunks that hold more than
RANGE_ROWS rows into ranges of rows along the full order (time and tie-breaks), so
that a crowded second, or all rows without a time, is many ranges. A window inside
each (keys, chunk, range) sees the marks of its own range; a summary with one row
per range carries the last mark of earlier ranges forward; a join on the range
brings it back. Only the summary is ever ordered across ranges.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from logtrail.session import write_stage

CHUNK, RANGE = "_chunk", "_range"
WIDTH = "1 hour"
# Rows of one range, and the sampled rows between two borders.
RANGE_ROWS = 1_000_000
SAMPLES = 64
MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


@dataclass(frozen=True)
class Mark:
    """Rows where `when` holds leave `payload` behind for the rows after them."""

    name: str
    when: Column
    payload: list[Column]
    include_current: bool = True


def chunk_width(text: str) -> int:
    """'15 minutes' -> microseconds."""
    number, unit = text.split()
    return int(number) * MICROS[unit.rstrip("s")]


@dataclass(frozen=True)
class Ranges:
    """How the rows of `keys`, ordered by `micros` and `ties`, are cut.

    `borders` has one row per crowded chunk: the keys, the chunk and the sorted
    orders at which a new range begins. Results do not depend on the cut.
    """

    keys: list[str]
    micros: str
    ties: list[str]
    width: str = WIDTH
    borders: DataFrame | None = field(default=None, compare=False)

    @property
    def order(self) -> list[str]:
        return [self.micros, *self.ties]

    @property
    def places(self) -> list[str]:
        """Columns that number the ranges of a key in order. Without borders the chunk
        alone: a constant beside it would cost a second shuffle."""
        return [CHUNK] if self.borders is None else [CHUNK, RANGE]

    @property
    def grouping(self) -> list[str]:
        return [*self.keys, *self.places]

    def chunk(self) -> Column:
        return F.floor(F.col(self.micros) / chunk_width(self.width)).alias(CHUNK)

    def number(self, df: DataFrame) -> DataFrame:
        """Add the chunk of each row and, where chunks are cut, the range number."""
        chunked = df.select("*", self.chunk())
        if self.borders is None:
            return chunked
        names = [*self.keys, CHUNK]
        borders = self.borders.select(*[F.col(name).alias(f"_border_{name}") for name in names], "_borders")
        here = F.struct(*self.order)
        number = F.size(F.filter("_borders", lambda border: border <= here))
        return (
            chunked.join(borders, [F.col(name) == F.col(f"_border_{name}") for name in names], "left")
            .withColumn(RANGE, F.when(F.col("_borders").isNull(), 0).otherwise(number))
            .drop("_borders", *[f"_border_{name}" for name in names])
        )

    def dealt(self, df: DataFrame) -> DataFrame:
        return self.number(df).repartition(*self.grouping)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.grouping).orderBy(*self.order)

    def across(self) -> WindowSpec:
        """Order of the summary rows of a key."""
        return Window.partitionBy(*self.keys).orderBy(*self.places)


def cut(
    measured: DataFrame, keys: list[str], micros: str, ties: list[str], width: str = WIDTH, rows: int = RANGE_ROWS
) -> Ranges:
    """Ranges of about `rows` rows for the rows of `measured` (or fewer copies of them).

    One partial aggregation counts the chunks. Where none is crowded, chunks are
    the ranges; else the borders are every SAMPLES-th of the chunk's sampled orders,
    a few thousandths of its rows. Samples are drawn by a hash of the order, so a
    repeated task draws the same.
    """
    whole = Ranges(keys, micros, ties, width)
    counted = measured.groupBy(*keys, whole.chunk()).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    crowded = write_stage(counted.drop("n"), "crowded-chunks")
    if not crowded.limit(1).count():
        return whole
    every = max(1, rows // SAMPLES)
    sampled = (
        measured.select(*keys, *whole.order, whole.chunk())
        .where(F.pmod(F.xxhash64(*whole.order), F.lit(every)) == 0)
        .join(crowded, [*keys, CHUNK], "left_semi")
    )
    sorted_orders = F.array_sort(F.collect_list(F.struct(*whole.order)))
    borders = sampled.groupBy(*keys, CHUNK).agg(
        F.filter(sorted_orders, lambda _, place: place % SAMPLES == SAMPLES - 1).alias("_borders")
    )
    return Ranges(keys, micros, ties, width, write_stage(borders, "range-borders"))


def carry_back(lines: DataFrame, summary: DataFrame, ranges: Ranges, names: list[str]) -> DataFrame:
    """Join the columns `names` of the summary to the rows of their range."""
    found = summary.select(*[F.col(name).alias(f"_key_{name}") for name in ranges.grouping], *names)
    on = [F.col(name) == F.col(f"_key_{name}") for name in ranges.grouping]
    return lines.join(found, on, "left").drop(*[f"_key_{name}" for name in ranges.grouping])


def running_last(
    df: DataFrame,
    ranges: Ranges,
    marks: list[Mark],
    within_range: Callable[[DataFrame], DataFrame] | None = None,
    summary_source: DataFrame | None = None,
) -> DataFrame:
    """Add one struct column per mark: (micros, tie-breaks, payload) of the last marked row.

    Order is `micros`, then the tie-breaks, all ascending; `micros` must not be
    null. `within_range` runs right after the window, on rows already grouped and
    sorted. `summary_source` may name a cheaper relation with the same rows (a
    written stage read back), so the summary scans only the columns it needs.
    Without keys the summary of the whole table is ordered in one task: one row
    per range, however many rows there are.
    """

    def marked(mark: Mark) -> Column:
        return F.when(mark.when, F.struct(*ranges.order, *mark.payload))

    spec = ranges.window()
    upto = {True: spec.rowsBetween(Window.unboundedPreceding, 0), False: spec.rowsBetween(Window.unboundedPreceding, -1)}
    lines = ranges.dealt(df)
    for mark in marks:
        lines = lines.withColumn(mark.name, F.last(marked(mark), ignorenulls=True).over(upto[mark.include_current]))
    if within_range is not None:
        lines = within_range(lines)

    earlier = ranges.across().rowsBetween(Window.unboundedPreceding, -1)
    source = ranges.number(summary_source) if summary_source is not None else ranges.dealt(df)
    summary = source.groupBy(*ranges.grouping).agg(*[F.max(marked(mark)).alias(mark.name) for mark in marks])
    carried = summary.select(
        *ranges.grouping,
        *[F.last(mark.name, ignorenulls=True).over(earlier).alias(f"_carried_{mark.name}") for mark in marks],
    )
    joined = carry_back(lines, carried, ranges, [f"_carried_{mark.name}" for mark in marks])
    for mark in marks:
        joined = joined.withColumn(mark.name, F.coalesce(mark.name, f"_carried_{mark.name}"))
    return joined.drop(*ranges.places, *[f"_carried_{mark.name}" for mark in marks])
