"""One small text file."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from kglake.plans import storage


def write_single_file(lines: DataFrame, path: str) -> None:
    """The one string column of a small report as a single headerless file named `path`; an older file is replaced."""
    spark = lines.sparkSession
    temporary = f"{path}.{uuid.uuid4().hex}.temp"
    lines.coalesce(1).write.text(temporary)
    part = next(name for name in storage.child_names(spark, temporary) if name.startswith("part-"))
    storage.replace_path(spark, f"{temporary}/{part}", path)
    storage.delete_path(spark, temporary)
