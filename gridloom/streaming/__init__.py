"""Workbooks that arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import ooxml


def arriving_workbooks(spark: SparkSession, folder: str, per_trigger: int = 16) -> DataFrame:
    """A stream of path and content, a few files at a time."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.xls[xm]").option("maxFilesPerTrigger", per_trigger).load(folder)


def arriving_cells(spark: SparkSession, folder: str, limits: ooxml.Limits | None = None) -> DataFrame:
    """A stream of the cells of arriving workbooks. No state is kept: write it
    with a checkpoint, and each file is read once."""
    return ooxml.from_files(arriving_workbooks(spark, folder), "cell", limits or ooxml.Limits())
