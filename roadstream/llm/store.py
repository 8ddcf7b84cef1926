"""Tables written once below the shared folder of the run, column names out of the way of
an operator's own, and the size of batches."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.operators.sizes import run_folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs only tasks that read the files.
    """
    spark = df.sparkSession
    folder = f"{run_folder(spark)}/table"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def shielded(df: DataFrame, used: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns other than ``used`` under names that no operator uses, and
    the old name of each column by the new one."""
    names = {c if c in used else f"given {i}": c for i, c in enumerate(df.columns)}
    return df.toDF(*names), names


def unshielded(df: DataFrame, names: dict[str, str], outputs: list[str] = ()) -> DataFrame:
    """The columns of ``shielded`` under their old names, then ``outputs``, which replace
    columns of the same name, in upper or lower case."""
    taken = {c.lower() for c in outputs}
    kept = [F.col(new).alias(old) for new, old in names.items() if old.lower() not in taken]
    return df.select(*kept, *outputs)


ROWS_PER_BATCH = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows per Arrow batch to ``ROWS_PER_BATCH``.

    Spark's default of 10,000 is meant for narrow rows. Of whole texts that is tens of
    MB, held several times over by each Python worker and its executor.
    """
    rows = int(spark.conf.get(BATCH_SETTING, "10000"))
    if not 0 < rows <= ROWS_PER_BATCH:
        spark.conf.set(BATCH_SETTING, str(ROWS_PER_BATCH))
