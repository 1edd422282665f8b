"""Sessions with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "lamina", master: str | None = None, remote: str | None = None, **settings: str) -> SparkSession:
    """A session by the engine's settings; keywords name further ones with dots as double underscores."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    if remote:
        return builder.remote(remote).getOrCreate()
    return (builder.master(master) if master else builder).getOrCreate()


def tuned(spark: SparkSession, shuffle_partitions: int | None = None, max_partition_bytes: str | None = None, open_cost: str | None = None, coalesce: bool | None = None) -> SparkSession:
    """Settings of one table group; what is None stays as it is."""
    given = {
        "spark.sql.shuffle.partitions": shuffle_partitions,
        "spark.sql.files.maxPartitionBytes": max_partition_bytes,
        "spark.sql.files.openCostInBytes": open_cost,
        "spark.sql.adaptive.coalescePartitions.enabled": None if coalesce is None else str(coalesce).lower(),
    }
    for k, v in given.items():
        if v is not None:
            spark.conf.set(k, str(v))
    return spark


def use_namespace(spark: SparkSession, namespace: str) -> str:
    """Make a catalog or database current, whichever spelling the catalog takes."""
    failure = None
    parts = namespace.split(".")
    for form in (namespace, ".".join(f"`{p}`" for p in parts), parts[-1]):
        try:
            spark.sql(f"USE {form}")
            return form
        except Exception as e:  # each catalog rejects other spellings with errors of its own
            failure = e
    raise ValueError(f"no namespace {namespace}") from failure
