"""From readings to scaled, split feature rows."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from roadstream.operators.features import (
    add_calendar,
    add_congestion_labels,
    add_series_features,
    encode_road_type,
    prepare_features_target,
)
from roadstream.operators.missing import fill_from, fill_missing
from roadstream.operators.scaling import standard_scale
from roadstream.operators.series import SeriesPlan, plan_series
from roadstream.operators.splits import positional_split, random_split, temporal_split


def processed_table(
    readings: DataFrame,
    roads: DataFrame,
    plan: SeriesPlan | None = None,
    roads_at_most: int | None = None,
    saved: DataFrame | None = None,
    fitted: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Labels, calendar, lags and rolling statistics, with missing values filled.

    ``saved`` has the values to fill with, as ``fitted`` gets them for other rows.
    """
    plan = plan or plan_series(readings)
    labelled = add_congestion_labels(readings, roads, roads_at_most)
    features = add_series_features(add_calendar(labelled), plan=plan, keep_blocks=True)
    if saved is not None:
        return fill_from(features, saved, plan)
    return fill_missing(features, plan, fitted=fitted)


def split_table(
    table: DataFrame, split: str = "temporal", plan: SeriesPlan | None = None
) -> DataFrame:
    """Mark the rows by a named split."""
    if split == "random":
        return random_split(table)
    cut = {"temporal": temporal_split, "positional": positional_split}[split]
    return cut(table, plan=plan)


def feature_rows(
    processed: DataFrame,
    task: str = "classification",
    split: str = "temporal",
    plan: SeriesPlan | None = None,
) -> tuple[DataFrame, list[str]]:
    """Feature rows of a processed table as doubles, split; and the features' names."""
    rows = split_table(prepare_features_target(encode_road_type(processed), task), split, plan)
    keys = ("segment_id", "timestamp", "label", "split")
    features = [c for c in rows.columns if c not in keys]
    numbers = [rows[c].cast("double").alias(c) for c in features]
    return rows.select(*[c for c in keys if c in rows.columns], *numbers), features


@dataclass(frozen=True)
class FeatureTables:
    processed: DataFrame
    scaled: DataFrame
    features: list[str]


def feature_tables(
    readings: DataFrame,
    roads: DataFrame,
    task: str = "classification",
    split: str = "temporal",
    roads_at_most: int | None = None,
) -> FeatureTables:
    """The processed table, and its feature rows split and scaled."""
    plan = plan_series(readings)
    processed = processed_table(readings, roads, plan, roads_at_most)
    rows, features = feature_rows(processed, task, split, plan)
    return FeatureTables(processed, standard_scale(rows, features), features)
