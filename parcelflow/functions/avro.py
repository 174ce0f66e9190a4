"""Avro binary without a container, for the shapes of `schemas`.

The avro package is used when the session has it. Without it, encoding is a
column expression and decoding a small Arrow function; both know the types the
envelope and the registry request use (text, int, enum, nested record, and
unions with null), not Avro in general.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession, functions as F, types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def package_available(spark: SparkSession) -> bool:
    try:
        spark.sql("SELECT to_avro(1)")
        return True
    except AnalysisException:
        return False


def _variable_int(number: Column) -> Column:
    """A zig-zag number as 1 to 5 bytes, seven bits each, lowest first, high bit set on all but the last."""

    def of_size(size: int) -> Column:
        packed = F.lit(0).cast("bigint")
        for at in range(size):
            seven = F.shiftright(number, 7 * at).bitwiseAND(F.lit(127))
            packed = packed + F.shiftleft(seven + (128 if at < size - 1 else 0), 8 * (size - 1 - at))
        return F.unhex(F.lpad(F.hex(packed), 2 * size, "0"))

    sized = F.when(number < 1 << 7, of_size(1))
    for size in (2, 3, 4):
        sized = sized.when(number < 1 << (7 * size), of_size(size))
    return sized.otherwise(of_size(5))


def _piece(number: Column, data: Column | None = None) -> Column:
    """A number and the bytes that follow it: every part of a record has this form."""
    return F.struct(number.cast("bigint").alias("number"), (data if data is not None else F.lit(b"")).alias("data"))


def _pieces(value: Column, avro: object) -> Column:
    """A value's pieces in order, as an array."""
    if isinstance(avro, list):
        branch = [b for b in avro if b != "null"][0]
        chosen = {name: F.array(_piece(F.lit(2 * avro.index(b)))) for name, b in (("null", "null"), ("value", branch))}
        return F.when(value.isNull(), chosen["null"]).otherwise(F.concat(chosen["value"], _pieces(value, branch)))
    if avro == "string":
        return F.array(_piece(2 * F.octet_length(value), value.cast("binary")))
    if avro == "int":
        wide = value.cast("bigint")
        return F.array(_piece(F.shiftleft(wide, 1).bitwiseXOR(F.shiftright(wide, 63))))
    if avro["type"] == "enum":
        # array_position counts from 1, the symbol's number is zig-zag: 2 * (position - 1).
        position = F.array_position(F.array(*[F.lit(s) for s in avro["symbols"]]), value)
        return F.array(_piece(F.when(position > 0, 2 * (position - 1))))
    return F.concat(*[_pieces(value.getField(f["name"]), f["type"]) for f in avro["fields"]])


def encode(value: Column, schema_json: str) -> Column:
    """A struct as Avro binary; NULL when a field that must have a value has none."""
    joined = F.reduce(
        _pieces(value, json.loads(schema_json)), F.lit(b""),
        lambda done, piece: F.concat(done, _variable_int(piece["number"]), piece["data"]),
    )
    return F.when(value.isNotNull(), joined)


def struct_type(avro: object) -> T.DataType:
    """Spark type of an Avro type."""
    if isinstance(avro, list):
        return struct_type([b for b in avro if b != "null"][0])
    if avro == "int":
        return T.IntegerType()
    if avro == "string" or avro["type"] == "enum":
        return T.StringType()
    return T.StructType([T.StructField(f["name"], struct_type(f["type"])) for f in avro["fields"]])


def _arrow_type(avro: object) -> pa.DataType:
    if isinstance(avro, list):
        return _arrow_type([b for b in avro if b != "null"][0])
    if avro == "int":
        return pa.int32()
    if avro == "string" or avro["type"] == "enum":
        return pa.string()
    return pa.struct([(f["name"], _arrow_type(f["type"])) for f in avro["fields"]])


def read_number(data: bytes, at: int) -> tuple[int, int]:
    shift = number = 0
    while True:
        byte = data[at]
        number |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return (number >> 1) ^ -(number & 1), at


Reader = Callable[[bytes, int], tuple[object, int]]


def _read_text(data: bytes, at: int) -> tuple[str, int]:
    size = data[at]
    if size < 128:
        size, at = (size >> 1) ^ -(size & 1), at + 1
    else:
        size, at = read_number(data, at)
    end = at + size
    if size < 0 or end > len(data):
        raise ValueError("text runs past the end")
    return data[at:end].decode("utf-8"), end


def reader(avro: object) -> Reader:
    """Reads the value starting at a place; gives it and where the next one starts. A record is a tuple of its fields.

    The schema is walked once, here, and not for every value.
    """
    if isinstance(avro, list):
        branches = [None if b == "null" else reader(b) for b in avro]

        def read_union(data: bytes, at: int) -> tuple[object, int]:
            branch, at = read_number(data, at)
            read = branches[branch]
            return (None, at) if read is None else read(data, at)

        return read_union
    if avro == "string":
        return _read_text
    if avro == "int":
        return read_number
    if avro["type"] == "enum":
        symbols = avro["symbols"]

        def read_symbol(data: bytes, at: int) -> tuple[str, int]:
            number, at = read_number(data, at)
            return symbols[number], at

        return read_symbol
    fields = [reader(f["type"]) for f in avro["fields"]]

    def read_record(data: bytes, at: int) -> tuple[tuple, int]:
        values = []
        for read in fields:
            value, at = read(data, at)
            values.append(value)
        return tuple(values), at

    return read_record


def _column(values: Sequence, arrow: pa.DataType) -> pa.Array:
    """Values as an Arrow column; records, as tuples, field by field."""
    if not pa.types.is_struct(arrow):
        return pa.array(values, type=arrow)
    absent = [value is None for value in values]
    nothing = (None,) * arrow.num_fields
    parts = zip(*[nothing if value is None else value for value in values]) if values else [()] * arrow.num_fields
    fields = list(arrow)
    columns = [_column(part, field.type) for part, field in zip(parts, fields, strict=True)]
    return pa.StructArray.from_arrays(columns, fields=fields, mask=pa.array(absent, type=pa.bool_()))


def decoder(schema_json: str):
    """Arrow function from binary to struct; bytes that do not fit the schema give NULL."""
    avro = json.loads(schema_json)
    arrow, read = _arrow_type(avro), reader(avro)

    @F.arrow_udf(struct_type(avro))
    def decode(values: pa.Array) -> pa.Array:
        rows = []
        for data in values.to_pylist():
            try:
                rows.append(None if data is None else read(data, 0)[0])
            except (IndexError, ValueError):
                rows.append(None)
        return _column(rows, arrow)

    return decode
