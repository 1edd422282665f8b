"""Sources: JDBC, Parquet by manifest, CSV dictionaries, JSON, catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import Storage


def pushed_query(schema: str, table: str, where: str | None) -> str:
    """What a JDBC read takes as its table: the table, or a subquery with a filter that the database runs."""
    name = f'"{schema}"."{table}"'
    return f"(SELECT * FROM {name} WHERE {where}) AS src" if where else name


def read_jdbc(spark: SparkSession, url: str, schema: str, table: str, where: str | None = None, fetch_size: int = 10_000, partition: tuple[str, object, object, int] | None = None, **options: str) -> DataFrame:
    """A database table; partition: (column, low, high, number) of ranges that are read side by side."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=pushed_query(schema, table, where), fetchsize=str(fetch_size), **options)
    if partition:
        column, low, high, n = partition
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(n))
    return reader.load()


def read_files(spark: SparkSession, manifest: dict) -> DataFrame:
    """Exactly the files that a manifest lists."""
    return spark.read.parquet(*(f["path"] for f in manifest["files"]))


def with_file_facts(df: DataFrame, facts: DataFrame, path: str = "path") -> DataFrame:
    """df with the facts of the file each row comes from, (path, ...), a table of a few rows for each batch.

    Paths are compared as Hadoop writes them, so a listing's paths fit.
    """
    own = df.select("*", F.url_decode(F.col("_metadata.file_path")).alias("file of row"))
    right = facts.withColumn("listed file", F.regexp_replace(F.url_decode(F.col(path)), "^file:/+", "file:/")).drop(path)
    return own.withColumn("file of row", F.regexp_replace("file of row", "^file:/+", "file:/")).join(right, F.col("file of row") == F.col("listed file")).drop("file of row", "listed file")


def read_dictionary(spark: SparkSession, path: str, schema: str | T.StructType, dates: str = "d/M/yyyy") -> DataFrame:
    """A CSV with a header, by an explicit schema; a byte-order mark in front is no part of the first name."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8")
    raw = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))

    def typed(f: T.StructField) -> Column:
        c = F.trim(F.col(f"`{f.name}`"))
        if isinstance(f.dataType, T.DateType):
            return F.to_date(c, dates)
        return (F.regexp_replace(c, ",", "") if isinstance(f.dataType, T.NumericType) else c).cast(f.dataType)

    return raw.select(*(typed(f).alias(f.name) for f in wanted))


def read_json_document(spark: SparkSession, path: str) -> dict | None:
    return Storage(spark).read_json(path)


def source_mapping(entries: list[dict], schema: str) -> dict[str, str]:
    """Table name to storage location, of one schema, by name."""
    return {e["table"]: e["location"] for e in sorted(entries, key=lambda e: e["table"]) if e.get("schema") == schema}


def expose(spark: SparkSession, mapping: dict[str, str], required: list[str], prefix: str = "") -> list[str]:
    """A view for every mapped table; raises, and makes none, if a required one has no mapping."""
    if absent := sorted({*required} - {*mapping}):
        raise ValueError(f"no location for {', '.join(absent)}")
    for name, location in sorted(mapping.items()):
        read_table(spark, location).createOrReplaceTempView(prefix + name)
    return sorted(prefix + n for n in mapping)


def has_delta(spark: SparkSession) -> bool:
    """Whether the session can read Delta tables."""
    try:
        spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
    except Exception:  # py4j wraps ClassNotFoundException
        return False
    return True


def read_table(spark: SparkSession, location: str) -> DataFrame:
    """The table in a folder: Delta where there is a log and the session reads it, Parquet otherwise."""
    if Storage(spark).exists(f"{location}/_delta_log") and has_delta(spark):
        return spark.read.format("delta").load(location)
    return spark.read.parquet(location)


def count_rows(df: DataFrame) -> int:
    return df.count()


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
