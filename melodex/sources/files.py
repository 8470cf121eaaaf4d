"""Readers, writers and the artifact folder."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.sources.schemas import ARTIFACTS, CATALOGUE_SCHEMA, ENCODER_PREFIX, HISTORY_SCHEMA


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    file_format: str = "parquet",
    columns: Sequence[str] | None = None,
    na_values: Sequence[str] = (),
) -> DataFrame:
    """Read CSV, parquet, ORC or JSON. CSV and JSON need a schema: nothing is inferred from the data.

    ``columns`` prunes the scan; ``na_values`` lists text tokens to read as null.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif file_format in ("csv", "json"):
        raise ValueError(f"reading {file_format} needs a schema")
    if file_format == "csv":
        # enforceSchema off: a file whose header differs from the schema is an error, not shifted columns
        reader = reader.options(header=True, escape='"', enforceSchema=False)
    df = reader.format(file_format).load(path)
    if columns is not None:
        df = df.select(*columns)
    if na_values:
        tokens = list(na_values)
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in texts})
    return df


def read_catalogue(spark: SparkSession, path: str, file_format: str = "csv", **options) -> DataFrame:
    schema = options.pop("schema", CATALOGUE_SCHEMA if file_format in ("csv", "json") else None)
    return read_table(spark, path, schema, file_format, **options)


def read_history(spark: SparkSession, path: str, file_format: str = "csv", **options) -> DataFrame:
    schema = options.pop("schema", HISTORY_SCHEMA if file_format in ("csv", "json") else None)
    return read_table(spark, path, schema, file_format, **options)


def write_table(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    writer = df.write.mode(mode).format(file_format)
    if file_format == "csv":
        writer = writer.options(header=True, escape='"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def store_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` at ``path`` as a table hashed by ``key`` into buckets, each sorted by it, and open it.

    Tables of equal buckets are joined and grouped by the key without a shuffle, however often. A task
    reads a bucket, so this suits tables in which no key holds a large share of the rows; others are better
    left as files, where Spark divides a skewed join.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def save_artifacts(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        write_table(table, f"{folder}/{name}")


def load_artifacts(
    spark: SparkSession, folder: str, names: Sequence[str] = ARTIFACTS
) -> dict[str, DataFrame]:
    """Open every artifact; one error names all that are missing."""
    tables: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name in names:
        path = f"{folder}/{name}"
        try:
            tables[name] = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(
            f"{len(missing)} artifacts are not in {folder}: {', '.join(missing)}; "
            "melodex.plans.pipeline.build_artifacts writes them"
        )
    return tables


def encoder_tables(artifacts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The fitted encoder's parameter tables among loaded artifacts."""
    return {
        name.removeprefix(ENCODER_PREFIX): table
        for name, table in artifacts.items()
        if name.startswith(ENCODER_PREFIX)
    }


def write_report(metrics: DataFrame, path: str, run: DataFrame | None = None) -> None:
    """Evaluation report as JSON lines: in ``metrics`` one row per model and k, in ``run`` one row about the data."""
    write_table(metrics, f"{path}/metrics", "json")
    if run is not None:
        write_table(run, f"{path}/run", "json")
