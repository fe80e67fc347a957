"""Typed scans and column whitelists (SRC-01, SRC-02, SRC-03, SRC-06, SRC-07)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from hydromart.sources import schemas


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """SRC-01 / SRC-03: Parquet scan; with a declared schema when given (no inference)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_communes_csv(spark: SparkSession, path: str, sep: str = ";",
                      schema: StructType = schemas.SEED_COMMUNES) -> DataFrame:
    """SRC-02: the semicolon-separated commune reference file, typed by its declared schema."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def read_json_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Landed API payloads (one JSON document per line), typed by a declared schema."""
    return spark.read.schema(schema).json(path)


def keep_columns(df: DataFrame, columns: Sequence[str] | Mapping[str, DataType],
                 default_type: DataType = StringType()) -> DataFrame:
    """SRC-06: keep exactly the expected columns in order; absent ones become typed NULLs."""
    types = dict(columns) if isinstance(columns, Mapping) else {c: None for c in columns}
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(None).cast(t or default_type).alias(c)
                       for c, t in types.items()])


def split_missing(df: DataFrame, column: str) -> dict[str, DataFrame]:
    """SRC-07: rows without ``column`` are rejected; ``kept`` and ``rejected`` frames.

    Count the rejects with ``rejected.count()`` or ``observe`` at the sink; nothing is collected here.
    """
    missing = F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")
    return {"kept": df.where(~missing), "rejected": df.where(missing)}
