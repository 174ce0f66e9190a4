"""Envelopes to Avro binary and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import avro as A


def encode_avro(df: DataFrame, struct: str, schema_json: str, name: str = "value") -> DataFrame:
    """Adds a struct column as Avro binary without a container header."""
    if A.package_available(df.sparkSession):
        from pyspark.sql.avro.functions import to_avro

        return df.withColumn(name, to_avro(F.col(struct), schema_json))
    return df.withColumn(name, A.encode(F.col(struct), schema_json))


def decode_avro(df: DataFrame, col: str, schema_json: str, name: str = "envelope") -> DataFrame:
    """Adds the struct an Avro binary column holds; NULL where the bytes do not fit."""
    if A.package_available(df.sparkSession):
        from pyspark.sql.avro.functions import from_avro

        return df.withColumn(name, from_avro(F.col(col), schema_json, {"mode": "PERMISSIVE"}))
    return df.withColumn(name, A.decoder(schema_json)(F.col(col)))


def decode_avro_as_json(df: DataFrame, col: str, schema_json: str, name: str = "json") -> DataFrame:
    """Adds the JSON text of an Avro binary column, NULL members included."""
    decoded = decode_avro(df, col, schema_json, "_decoded")
    return decoded.withColumn(name, F.to_json("_decoded", {"ignoreNullFields": "false"})).drop("_decoded")
