"""Work on each segment's readings in time order, however long the series is.

A window partitioned by segment puts a whole series into one task. That is right
while every series is short. ``plan_series`` counts the rows per segment, and for
the segments above ``block_rows`` it finds time blocks of about ``block_rows``
rows from a histogram. ``windowed`` then evaluates bounded frames per (segment,
block), each block together with the few rows around it that its frames reach,
and ``running`` carries unbounded frames across blocks. Both are exact, and both
move every wide row through one shuffle.

Segment and time together identify a reading, which makes the order total. Where they
do not, ``plan_series`` takes the columns that order readings of equal time (``ties``).

The plan holds counts only, in written tables: about ``CELLS_PER_BLOCK`` histogram cells
for each block. Blocks of the default size number at most ``MAX_BLOCKS``, whatever the size
of the data. The tables of smaller blocks grow with the data. Those of at most ``PLAN_ROWS``
rows are broadcast; joins shuffle the others.
"""

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadstream.functions.clock import clock_micros
from roadstream.operators.sizes import (
    SMALL_ROWS,
    checkpointed,
    dimension_join,
    is_small,
    prefix_sum,
)
from roadstream.params import SEGMENT, TIMESTAMP

MAX_BLOCKS = 20_000
CELLS_PER_BLOCK = 16
# A query may hold several tables of its plan at once, as hash tables keyed by text of some
# 160 bytes a row, on the driver too while it builds them.
PLAN_ROWS = 200_000
HELPERS = ("_block", "_own", "_base", "_total")


@dataclass(frozen=True)
class Step:
    """The start of each cell that one refinement cuts, and the width of its parts."""

    table: DataFrame
    rows: int


@dataclass(frozen=True)
class SeriesPlan:
    """Row and segment counts of the data and the histogram of its long series."""

    rows: int
    segments_at_most: int
    block_rows: int
    steps: list[Step] = field(default_factory=list)
    histogram: DataFrame | None = None  # a row per cell: its rows, those before it, its block
    ties: tuple[str, ...] = ()
    limit: int = PLAN_ROWS

    @property
    def split(self) -> bool:
        return self.histogram is not None

    @cached_property
    def cells(self) -> pd.DataFrame:
        """The histogram, for a look at a small one."""
        return self.histogram.toPandas()

    @cached_property
    def blocks_at_most(self) -> int:
        """A segment of n rows has at most n / block_rows + 1 blocks."""
        return self.rows // self.block_rows + self.steps[0].rows

    @property
    def moment(self) -> Column:
        """What orders the rows of a segment, as one value."""
        return F.struct(TIMESTAMP, *self.ties)

    def narrow(self, df: DataFrame, *columns: str) -> DataFrame:
        """These columns and those that order the rows."""
        return df.select(*dict.fromkeys([SEGMENT, TIMESTAMP, *columns, *self.ties]))


@dataclass(frozen=True)
class Series:
    """What an operator needs to address the rows of one series."""

    window: WindowSpec
    position: Column  # 0-based
    length: Column


def _locate(df: DataFrame, steps: list[Step], how: str, limit: int) -> DataFrame:
    """Add ``_cell``, the start of the histogram cell each row falls into, and ``_width``, that
    cell's width. Rows without a time come first in their series, so they are in its first cell."""
    df = df.withColumn("_t", clock_micros(df, TIMESTAMP))
    for level, step in enumerate(steps):
        table = step.table.withColumnRenamed("_width", "_new")
        on = [SEGMENT, "_cell"] if level else [SEGMENT]
        df = dimension_join(df, table, on, "left" if level else how, step.rows, limit)
        cell, new = F.col("_cell"), F.col("_new")
        inside = cell + F.floor((F.coalesce("_t", cell) - cell) / new) * new
        width = F.coalesce("_new", "_width") if level else new
        df = df.withColumns({"_cell": F.coalesce(inside, cell), "_width": width}).drop("_new")
    return df.drop("_t")


def plan_series(
    df: DataFrame,
    block_rows: int | None = None,
    ties: tuple[str, ...] = (),
    limit: int = PLAN_ROWS,
) -> SeriesPlan:
    """Count the rows and, where a series is long, find where to cut it.

    Rows of equal segment and time are ordered by the ``ties`` columns, nulls first;
    they stay in one block. Tables of the plan with more than ``limit`` rows are shuffled.
    """
    return replace(_cut_plan(df, block_rows, limit), ties=tuple(ties))


def _cut_plan(df: DataFrame, block_rows: int | None, limit: int) -> SeriesPlan:
    rows = df.count()
    if block_rows is None:
        block_rows = max(SMALL_ROWS, rows // MAX_BLOCKS)
    if rows <= block_rows:
        return SeriesPlan(rows, rows, block_rows)
    t = clock_micros(df, TIMESTAMP)
    spans = checkpointed(
        df.groupBy(SEGMENT).agg(
            F.count("*").alias("n"),
            F.coalesce(F.min(t), F.lit(0)).alias("_cell"),
            F.coalesce(F.max(t) - F.min(t) + 1, F.lit(1)).alias("_width"),
        )
    )
    long = spans.filter((F.col("n") > block_rows) & F.col(SEGMENT).isNotNull())
    segments, long_segments = spans.count(), long.count()
    if not long_segments:
        return SeriesPlan(rows, segments, block_rows)

    cell_rows = max(1, block_rows // CELLS_PER_BLOCK)
    heavy, number, steps, keys = long, long_segments, [], df.select(SEGMENT, TIMESTAMP)
    while number:
        pieces = F.ceil(F.col("n") / cell_rows)
        width = F.greatest(F.lit(1), F.ceil(F.col("_width") / pieces))
        step = checkpointed(heavy.select(SEGMENT, "_cell", width.alias("_width")))
        steps.append(Step(step, number))
        # Every step cuts a heavy cell into n / cell_rows pieces, so the cells of
        # all steps together number at most a small multiple of rows / cell_rows.
        cells = checkpointed(
            _locate(keys, steps, "inner", limit)
            .groupBy(SEGMENT, "_cell")
            .agg(F.count("*").alias("n"), F.max("_width").alias("_width"))
        )
        # Those of the last step that are still above a block and can be cut.
        heavy = cells.filter((F.col("n") > block_rows) & (F.col("_width") > 1))
        number = heavy.count()

    placed = prefix_sum(
        cells.select(SEGMENT, "_cell", "n"),
        [SEGMENT],
        ["_cell"],
        "n",
        "_before",
        cells.count(),
        limit,
    ).withColumn("_block", F.floor(F.col("_before") / block_rows))
    totals = long.select(SEGMENT, F.col("n").alias("_total"))
    histogram = checkpointed(
        dimension_join(placed, totals, SEGMENT, rows_at_most=long_segments, limit=limit)
    )
    return SeriesPlan(rows, segments, block_rows, steps, histogram, limit=limit)


def _targets(plan: SeriesPlan, lookback: int, lookahead: int) -> DataFrame:
    """For each cell, the blocks that read it: its own, and those it borders.

    Cells and blocks are intervals of positions in a series. They meet in stretches of
    ``block_rows`` positions; a pair counts in the stretch where the later one starts.
    """
    cells = plan.histogram.withColumnsRenamed({"_block": "_home", "_before": "_low"}).withColumn(
        "_high", F.col("_low") + F.col("n")
    )
    blocks = cells.groupBy(SEGMENT, F.col("_home").alias("_block")).agg(
        F.greatest(F.lit(0), F.min("_low") - lookback).alias("_from"),
        (F.max("_high") + lookahead).alias("_to"),
    )

    def stretch(position: Column) -> Column:
        return F.floor(position / plan.block_rows)

    def stretches(df: DataFrame, start: str, end: str) -> DataFrame:
        every = F.sequence(stretch(F.col(start)), stretch(F.col(end) - 1))
        return df.withColumn("_stretch", F.explode(every))

    # Estimates miss the rows that ``explode`` adds, so a broadcast could be of any size.
    pairs = stretches(blocks, "_from", "_to").join(
        stretches(cells, "_low", "_high").hint("shuffle_merge"), [SEGMENT, "_stretch"]
    )
    meet = (F.col("_low") < F.col("_to")) & (F.col("_from") < F.col("_high"))
    once = stretch(F.greatest("_low", "_from")) == F.col("_stretch")
    return pairs.filter(meet & once).select(
        SEGMENT,
        "_cell",
        "_block",
        (F.col("_home") == F.col("_block")).alias("_own"),
        F.min("_low").over(Window.partitionBy(SEGMENT, "_block")).alias("_base"),
        "_total",
    )


def _spread(df: DataFrame, plan: SeriesPlan, lookback: int, lookahead: int) -> DataFrame:
    """Rows with their block; rows near a border appear once per block that reads them."""
    targets = checkpointed(_targets(plan, lookback, lookahead))
    few = is_small(targets, limit=plan.limit)
    targets = F.broadcast(targets) if few else targets.hint("shuffle_merge")
    located = _locate(df, plan.steps, "left", plan.limit)
    return (
        located.join(targets, [SEGMENT, "_cell"], "left")
        .select(
            *df.columns,
            F.coalesce("_block", F.lit(0)).cast("bigint").alias("_block"),
            F.coalesce("_own", F.lit(True)).alias("_own"),
            F.coalesce("_base", F.lit(0)).cast("bigint").alias("_base"),
            "_total",
        )
        .repartition(SEGMENT, "_block")
    )


def _series(extra: tuple[str, ...], split: bool, ties: tuple[str, ...]) -> Series:
    keys = [SEGMENT, *extra]
    if split:
        keys.append("_block")
    ordered = Window.partitionBy(*keys).orderBy(TIMESTAMP, *ties)
    position = F.row_number().over(ordered).cast("bigint") - 1
    length = F.count("*").over(Window.partitionBy(*keys))
    if split:
        position, length = position + F.col("_base"), F.coalesce(F.col("_total"), length)
    return Series(ordered, position, length)


def windowed(
    df: DataFrame,
    build: Callable[[DataFrame, Series], DataFrame],
    lookback: int = 0,
    lookahead: int = 0,
    plan: SeriesPlan | None = None,
    keep_blocks: bool = False,
) -> DataFrame:
    """Apply ``build`` to each series; its frames reach at most the stated rows.

    ``build`` adds columns and keeps every row. ``keep_blocks`` leaves the block
    columns of a cut series in place, so that ``running`` needs no second shuffle.
    """
    plan = plan or plan_series(df)
    if not plan.split:
        return build(df, _series((), False, plan.ties))
    spread = _spread(df, plan, lookback, lookahead)
    built = build(spread, _series((), True, plan.ties)).filter("_own")
    return built if keep_blocks else built.drop(*HELPERS)


def running(
    df: DataFrame,
    within: Callable[[DataFrame, WindowSpec], DataFrame],
    summarise: dict[str, Column],
    combine: Callable[[DataFrame, WindowSpec], DataFrame],
    carried: list[str],
    finish: Callable[[DataFrame], DataFrame],
    keys: tuple[str, ...] = (),
    plan: SeriesPlan | None = None,
) -> DataFrame:
    """Frames that start at the first row of the series.

    ``within`` computes them inside a block and ``summarise`` reduces each block
    to one row. ``combine`` folds the rows of the earlier blocks, given a window
    over them, into the ``carried`` columns that ``finish`` merges with the inner
    result. For a series that is one block those columns are null.

    ``keys`` name columns that, beside the segment, separate series.
    """
    plan = plan or plan_series(df)
    ordered = _series(keys, plan.split, plan.ties).window
    inner = ordered.rowsBetween(Window.unboundedPreceding, 0)
    if not plan.split:
        unset = {name: F.lit(None) for name in carried}
        return finish(within(df, inner).withColumns(unset)).drop(*carried)
    placed = df if "_block" in df.columns else _spread(df, plan, 0, 0)
    blocks = within(placed, inner)
    block = [SEGMENT, *keys, "_block"]
    # Only long series have earlier blocks. The join is on the partition key, so it
    # moves below the windows and the shuffle that led to ``df``. One row per block
    # (and per extra key) is left; the plan bounds the number of blocks.
    long = plan.steps[0]
    sums = (
        dimension_join(
            blocks, long.table.select(SEGMENT), SEGMENT, "left_semi", long.rows, plan.limit
        )
        .groupBy(*block)
        .agg(*[column.alias(name) for name, column in summarise.items()])
    )
    earlier = (
        Window.partitionBy(SEGMENT, *keys)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = combine(sums, earlier).select(*block, *carried)
    few = plan.blocks_at_most * len(carried) <= plan.limit
    carry = F.broadcast(carry) if few else carry.hint("shuffle_merge")
    joined = blocks.join(carry, block, "left").select(*blocks.columns, *carried)
    return finish(joined).drop(*carried, *HELPERS)
