"""Least squares over any number of rows from one aggregate of their products."""

from collections.abc import Iterable
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ONE = "_one"


def products(df: DataFrame, names: list[str]) -> np.ndarray:
    """Sums of the products of 1 and all columns, over the rows where all are known.

    One pass with a partial sum in each task; only the square matrix comes to the
    driver, whatever the number of rows.
    """
    columns = [ONE, *names]
    rows = VectorAssembler(inputCols=columns, outputCol="v", handleInvalid="skip").transform(
        df.select(F.lit(1.0).alias(ONE), *[F.col(c).cast("double").alias(c) for c in names])
    )
    # A row of zeros, which adds nothing, stands for an empty table.
    zeros = df.sparkSession.range(1).select(array_to_vector(F.array_repeat(F.lit(0.0), len(columns))))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("v").union(zeros), "v")
    return RowMatrix(vectors, 0, len(columns)).computeGramianMatrix().toArray()


def solve(sums: np.ndarray, penalties: list[float] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and remaining squares from symmetric sums of products.

    With k penalties, the first k columns explain each of the others; a penalty is added
    to the square of its column. Without any, the last column is the only target.
    """
    k = len(penalties) if penalties is not None else len(sums) - 1
    left = sums[:k, :k] + np.diag(penalties if penalties is not None else np.zeros(k))
    right = sums[:k, k:]
    found = np.linalg.lstsq(left, right, rcond=None)[0]
    rest = np.diag(sums[k:, k:]) - (found * right).sum(axis=0)
    return found, rest


def linear(values: list[float], columns: list[Column]) -> Column:
    """Sum of the columns times the values; null if any column is."""
    return reduce(add, [F.lit(float(v)) * c for v, c in zip(values, columns, strict=True)])


def weight_table(spark: SparkSession, names: Iterable[str], weights: list[float]) -> DataFrame:
    """Weights by the name of their term, to be saved."""
    return spark.createDataFrame(list(zip(names, weights, strict=True)), "term string, weight double")
