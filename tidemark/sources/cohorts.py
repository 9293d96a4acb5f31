"""Several tables that become visible together.

A cohort's rows are written to each table under the cohort's own folder, and its
manifest, one row with each table's row count, last. Readers see the cohorts
that have a manifest, so one that stopped between two tables is not there; the
same cohort again is a no-op once it is complete, and before that replaces what
its first try left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import delete, exists


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """cohort and rows (a map from table to count) of every complete cohort."""
    if not exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], "rows map<string,long>, cohort string")
    return spark.read.schema("rows map<string,long>, cohort string").parquet(f"{path}/manifest")


def is_complete(spark: SparkSession, path: str, cohort: str) -> bool:
    return not manifests(spark, path).filter(F.col("cohort") == cohort).isEmpty()


def stage(df: DataFrame, path: str, table: str, cohort: str) -> int:
    """Write one table of a cohort; nobody sees it yet. The number of its rows."""
    folder = f"{path}/{table}/cohort={cohort}"
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).count()


def commit(tables: dict[str, DataFrame], path: str, cohort: str) -> bool:
    """Write the tables of a cohort and then its manifest; False if it was complete before, and nothing is written."""
    spark = next(iter(tables.values())).sparkSession
    if is_complete(spark, path, cohort):
        return False
    delete(spark, f"{path}/manifest/cohort={cohort}")
    counts = {name: stage(df, path, name, cohort) for name, df in tables.items()}
    spark.createDataFrame([(counts,)], "rows map<string,long>").coalesce(1).write.parquet(f"{path}/manifest/cohort={cohort}")
    return True


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows of a table of all complete cohorts, with cohort."""
    rows = spark.read.parquet(f"{path}/{table}").withColumn("cohort", F.col("cohort").cast("string"))
    return rows.join(manifests(spark, path).select("cohort"), "cohort", "left_semi")
