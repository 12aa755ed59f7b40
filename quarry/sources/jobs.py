"""Statements under a name, so that they can be cancelled from elsewhere."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def cancellable(spark: SparkSession, name: str | None = None) -> Iterator[str]:
    """Jobs started within belong to a group; cancel() with its name ends them."""
    group = name or uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group, interruptOnCancel=True)
    try:
        yield group
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(key, None)


def cancel(spark: SparkSession, group: str) -> None:
    spark.sparkContext.cancelJobGroup(group)
