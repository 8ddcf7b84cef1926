"""Missing values: report, exact medians, fill."""

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.operators.features import forward_fill, series_feature_names
from roadstream.operators.series import HELPERS, SeriesPlan, plan_series
from roadstream.operators.sizes import SMALL_ROWS, checkpointed

BINS = 16384
# percentile_approx is off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000


def null_report(df: DataFrame) -> DataFrame:
    """One row: nulls per column, and in total."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0))
    return counts.withColumn("total", total.cast("bigint"))


@dataclass(frozen=True)
class _Range:
    """Part of a column's values that is being counted.

    ``outside`` counts the values beyond both ends as well, as one bin each.
    """

    column: str
    low: float
    high: float
    outside: bool = False

    def bin(self) -> Column:
        """Number of the value's bin; it grows with the value, rounding included."""
        value = F.col(self.column).cast("double")
        if self.high > self.low:
            inside = F.floor((value - self.low) / (self.high - self.low) * (BINS - 1))
        else:
            inside = F.lit(0)
        return F.when(value.between(self.low, self.high), inside.cast("bigint"))


def exact_medians(
    df: DataFrame, columns: list[str], rows: int | None = None, limit: int = SMALL_ROWS
) -> dict[str, float | None]:
    """Exact interpolated median of each column.

    ``percentile`` keeps every distinct value of a column in one task. Up to
    ``limit`` rows that takes one pass. Above, an approximate percentile gives a
    narrow range around the middle. The next pass counts, for all columns, the
    rows below it, above it and in ``BINS`` bins inside; each further pass cuts
    the bin that holds a middle rank, until the middle values are known. The
    counts decide, so a poor first range costs a pass and not the result. Only
    values inside the ranges, few of each column, become rows of their own. A pass
    returns at most ``BINS`` rows per range and one row of counts. The passes read
    ``df`` again each time, so it should be a written table.
    """
    if (df.count() if rows is None else rows) <= limit:
        # As rows, so that the columns are spread over the tasks.
        values = [
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
        medians = (
            df.select(F.inline(F.array(*values)))
            .groupBy("name")
            .agg(F.percentile("value", 0.5).alias("median"))
        )
        return {c: None for c in columns} | {row.name: row.median for row in medians.collect()}

    near = [0.5 - 2 / ACCURACY, 0.5 + 2 / ACCURACY]
    first = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.percentile_approx(c, near, ACCURACY).alias(f"near_{c}") for c in columns],
    ).first()
    wanted: dict[_Range, set[int]] = {}
    for c in columns:
        if n := first[f"n_{c}"]:
            low, high = map(float, first[f"near_{c}"])
            wanted[_Range(c, low, high, outside=True)] = {(n - 1) // 2, n // 2}
    found = defaultdict(list)
    while wanted:
        bins, narrowed = _bin_counts(df, list(wanted)), defaultdict(set)
        for part, ranks in wanted.items():
            for rank in ranks:
                count, low, high, rank = _holder(bins[part], rank)
                if rank == 0 or low == high:
                    found[part.column].append(low)
                elif rank == count - 1:
                    found[part.column].append(high)
                else:
                    narrowed[_Range(part.column, low, high)].add(rank)
        wanted = narrowed
    return {c: math.fsum(found[c]) / len(found[c]) if found[c] else None for c in columns}


def _holder(bins: list[tuple], rank: int) -> tuple:
    """The bin (rows, least, greatest) with the row of a rank, and its rank inside."""
    for count, low, high in bins:
        if rank < count:
            return count, low, high, rank
        rank -= count
    raise ValueError("rank beyond the counted rows")


def _bin_counts(df: DataFrame, ranges: list[_Range]) -> dict[_Range, list[tuple]]:
    """(rows, least, greatest) of each non-empty bin of each range, in order."""
    out: dict[_Range, list[tuple]] = defaultdict(list)
    beyond = {}
    for i, part in enumerate(ranges):
        if part.outside:
            value = F.col(part.column).cast("double")
            for side, inside in (("a", value < part.low), ("b", value > part.high)):
                held = F.when(inside, value)
                beyond[i, side] = F.struct(F.count(held), F.min(held), F.max(held))
    ends = {}
    if beyond:
        columns = [c.alias(f"{side}{i}") for (i, side), c in beyond.items()]
        row = df.agg(*columns).first()
        ends = {key: tuple(row[f"{key[1]}{key[0]}"]) for key in beyond}
    items = [
        F.when(
            part.bin().isNotNull(),
            F.struct(
                F.lit(i).alias("part"),
                part.bin().alias("bin"),
                F.col(part.column).cast("double").alias("value"),
            ),
        )
        for i, part in enumerate(ranges)
    ]
    counted = (
        df.select(F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("item"))
        .groupBy("item.part", "item.bin")
        .agg(F.count("*").alias("n"), F.min("item.value"), F.max("item.value"))
        .collect()
    )
    for part, _, n, low, high in sorted(counted):
        out[ranges[part]].append((n, low, high))
    for i, part in enumerate(ranges):
        if part.outside:
            both = [ends[i, "a"], *out[part], ends[i, "b"]]
            out[part] = [one for one in both if one[0]]
    return out


def approximate_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Median of each column to one part in ``ACCURACY`` of the rows, in one pass."""
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), 0.5, ACCURACY).alias(c) for c in columns]
    ).first()
    return row.asDict()


def fill_missing(
    df: DataFrame,
    plan: SeriesPlan | None = None,
    limit: int = SMALL_ROWS,
    approx: bool = False,
    fitted: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Forward-fill the series features, then fill what is left.

    Numbers become double and take the median of their column over all segments,
    other types take 0. A number column without any value stays null.

    The forward-filled table is written once to the shared folder; null counts,
    medians and the result read it there, so the windows are computed once. Each
    series starts with unknown lags, so those columns always need a median.
    ``approx`` takes approximate medians in one pass. The medians of all number
    columns with gaps are put into ``fitted``, as the table of ``fill_from``.
    """
    plan = plan or plan_series(df)
    series = series_feature_names(df)
    types = dict(df.dtypes)
    filled = checkpointed(forward_fill(df, series, plan))
    others = filled.drop(*series, *HELPERS)
    nulls = null_report(others).first()
    gaps = [c for c in others.columns if nulls[c]]
    numeric = [c for c in [*series, *gaps] if types[c] in NUMBERS]
    medians: dict[str, float | None] = {}
    if numeric and approx:
        medians = approximate_medians(filled, numeric)
    elif numeric:
        medians = exact_medians(filled, numeric, plan.rows, limit)
    if fitted is not None:
        fitted["fill_values"] = df.sparkSession.createDataFrame(
            list(medians.items()), "feature string, value double"
        )
    return _filled(filled, medians, [c for c in gaps if c not in medians])


NUMBERS = ("int", "bigint", "float", "double")


def _filled(df: DataFrame, medians: dict[str, float | None], others: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    fills.update({c: F.coalesce(c, F.lit(False)) for c in others if types[c] == "boolean"})
    fills.update({c: F.coalesce(c, F.lit("0")) for c in others if types[c] == "string"})
    return df.withColumns(fills) if fills else df


def fill_from(
    df: DataFrame, saved: DataFrame, plan: SeriesPlan | None = None
) -> DataFrame:
    """Fills new rows from the values that ``fill_missing`` put out for earlier ones.

    ``saved`` has one row per column. Nothing of ``df`` is counted or read beforehand.
    """
    values = {r.feature: r.value for r in saved.collect() if r.feature in df.columns}
    filled = forward_fill(df, series_feature_names(df), plan)
    others = [c for c in df.columns if c not in values and c not in HELPERS]
    return _filled(filled, values, others)
