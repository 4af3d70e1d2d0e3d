"""Readings files: explicit schemas, date parsing, prediction output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURES = [f"V_{i}" for i in range(1, 14)]


def readings_schema(outcome: bool = True, id_type: T.DataType | None = None) -> T.StructType:
    """Schema of a readings file; scoring files have no ``POWER`` column."""
    fields = [
        T.StructField("ID", id_type or T.LongType()),
        T.StructField("SOT", T.StringType()),
        T.StructField("DATE", T.StringType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("LON", T.DoubleType()),
    ]
    fields += [T.StructField(name, T.DoubleType()) for name in MEASURES]
    if outcome:
        fields.append(T.StructField("POWER", T.DoubleType()))
    return T.StructType(fields)


READINGS_SCHEMA = readings_schema()


def read_readings(
    spark: SparkSession, path: str, schema: T.StructType | None = READINGS_SCHEMA, fmt: str = "csv"
) -> DataFrame:
    """Read a CSV with a header, or Parquet. ``schema=None`` infers, which costs one more pass.

    CSV columns are matched by header position, so the schema must list them in file order; a
    header that disagrees with the schema is an error (``enforceSchema=False``).
    """
    if fmt == "parquet":
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """The submission template: one row per reading to predict."""
    return read_readings(spark, path, T.StructType.fromDDL("ID bigint, POWER double"))


def parse_date(df: DataFrame, col: str = "DATE", fmt: str = "y/M/d", sort: bool = False) -> DataFrame:
    """Text to date. Only sorts on request: row order is not a property of a distributed table."""
    out = df.withColumn(col, F.to_date(F.col(col), fmt))
    return out.orderBy(F.col(col).asc_nulls_last()) if sort else out


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write predictions as CSV with a header; one part file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def submission_path(folder: str, wflow_id: str, prefix: str) -> str:
    return f"{folder}/Submittion_{wflow_id}_{prefix}.csv"  # file name pattern: fixed value


def profile_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, table width and row count."""
    names = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"))
        for i, (name, kind) in enumerate(df.dtypes)
    ])
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_rows", F.explode(names).alias("c")).select(
        "c.position", "c.column_name", "c.data_type", "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )
