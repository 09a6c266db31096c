"""JSON-lines input with an explicit schema (no inference; absent fields are NULL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_json(spark: SparkSession, path: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """Read JSON lines with a fixed schema, e.g. ``"name string, age bigint"``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).json(paths)
