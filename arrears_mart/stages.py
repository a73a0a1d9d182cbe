"""Intermediate tables that cut lineage: written once, read many times, and there after an executor is lost."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def stage_folder(spark: SparkSession) -> str:
    """The shared folder the session names; where it names none, one in its warehouse, which is shared as well."""
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_folder(spark)}/arrears_mart/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """`df` written as Parquet and read back with its own schema; the new folder is added to `made`."""
    path = new_stage_path(df.sparkSession, name)
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders that nobody reads any more, wherever Spark keeps them."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
