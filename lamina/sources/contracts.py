"""Table contracts: ordered columns with types and nullability."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The contract vocabulary and Spark's types.
TYPES: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(),
    "SHORT": T.ShortType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool = True
    position: int = 0


def spark_type(kind: str) -> T.DataType:
    """A contract type; what the vocabulary lacks is text."""
    if m := re.fullmatch(r"DECIMAL\((\d+), ?(\d+)\)", kind.strip().upper()):
        return T.DecimalType(int(m[1]), int(m[2]))
    return TYPES.get(kind.strip().upper(), T.StringType())


def contract_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    if isinstance(kind, T.TimestampNTZType):
        return "TIMESTAMP"
    return next((k for k, v in TYPES.items() if v == kind), "STRING")


def from_schema(schema: T.StructType) -> list[Field]:
    return [Field(f.name, contract_type(f.dataType), f.nullable, i) for i, f in enumerate(schema)]


def from_json(columns: list[dict]) -> list[Field]:
    """A contract from its document, in order of position."""
    own = [Field(c["name"], c["type"], c.get("nullable", True), c.get("position", i)) for i, c in enumerate(columns)]
    return sorted(own, key=lambda f: f.position)


def to_schema(contract: list[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, spark_type(f.kind), f.nullable) for f in contract])


def align(df: DataFrame, contract: list[Field]) -> tuple[DataFrame, list[str]]:
    """df with the contract's columns in its order and types, and the columns left out.

    A nullable column that is missing becomes null; one that may not be null raises.
    """
    if absent := [f.name for f in contract if f.name not in df.columns and not f.nullable]:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    picked = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(spark_type(f.kind)).alias(f.name) for f in contract]
    return df.select(*picked), [c for c in df.columns if c not in {f.name for f in contract}]


def differences(df: DataFrame, contract: list[Field], nullability: bool = False) -> list[str]:
    """How a table's columns differ from a contract by name, type and position."""
    own, out = from_schema(df.schema), []
    for i in range(max(len(own), len(contract))):
        a, b = own[i] if i < len(own) else None, contract[i] if i < len(contract) else None
        if a is None or b is None:
            out.append(f"{i}: {'no' if a is None else 'extra'} column {(a or b).name}")
        elif (a.name, a.kind) != (b.name, contract_type(spark_type(b.kind))):
            out.append(f"{i}: {a.name} {a.kind} is not {b.name} {b.kind}")
        elif nullability and a.nullable and not b.nullable:
            out.append(f"{i}: {a.name} may be null")
    return out


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register(spark: SparkSession, name: str, location: str, contract: list[Field], replace: bool = False) -> bool:
    """An external table of the catalog over a location; whether it is new."""
    if spark.catalog.tableExists(name):
        if not replace:
            return False
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=location, source="parquet", schema=to_schema(contract))
    return True
