"""Column expressions that decode and render change rows.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and run the same way on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import (
    OP_NAMES,
    OPERATION,
    SEQVAL,
    START_LSN,
    TABLE_NAME,
    ZERO_CURSOR_HEX,
    q,
    source_columns,
)

JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def operation_type(op="__$operation") -> Column:
    """1 -> Delete, 2 -> Insert, 3/4 -> Update; any other code or NULL -> NULL."""
    op = _col(op)
    out = None
    for code, name in sorted(OP_NAMES.items()):
        out = F.when(op == code, F.lit(name)) if out is None else out.when(op == code, F.lit(name))
    return out


def lsn_hex(c) -> Column:
    """Binary LSN or sequence value as lowercase hex."""
    return F.lower(F.hex(_col(c)))


def lsn_display(c) -> Column:
    """LSN as ``vvvvvvvv:bbbbbbbb:ssss`` (8:8:4 hex digits)."""
    h = F.lower(F.hex(_col(c)))
    return F.concat_ws(":", F.substring(h, 1, 8), F.substring(h, 9, 8), F.substring(h, 17, 4))


def lsn_literal(hex_value: str) -> Column:
    """Binary literal from a hex string (for example the zero cursor)."""
    return F.lit(bytearray.fromhex(hex_value))


def zero_cursor() -> Column:
    return lsn_literal(ZERO_CURSOR_HEX)


def lsn_from_long(c) -> Column:
    """10-byte big-endian binary from a non-negative integer column."""
    return F.unhex(F.lpad(F.hex(_col(c)), 20, "0"))


def utc_timestamp(c) -> Column:
    """A ``TIMESTAMP`` as the zone-less time of day in UTC, whatever the session's zone."""
    micros = F.unix_micros(_col(c)).cast("decimal(38,0)")
    seconds = (micros / F.lit(1_000_000).cast("decimal(38,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def stringify(name: str, dtype: T.DataType) -> Column:
    """Render one data column as a nullable string, NULL kept.

    strings as is; numbers by cast; timestamps in UTC as ISO-8601 with a ``T``
    and a trailing ``Z`` (fraction trimmed; zone-less ones as they are);
    booleans ``true``/``false``; binary as base64; arrays, maps and structs as
    JSON.
    """
    return stringify_value(F.col(q(name)), dtype)


def stringify_value(c: Column, dtype: T.DataType) -> Column:
    """``stringify`` of an expression of the given type."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.TimestampType):
        c = utc_timestamp(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.replace(c.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    if isinstance(dtype, T.BinaryType):
        return F.base64(c)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def data_struct(df: DataFrame, columns: list[str] | None = None) -> Column:
    """``struct`` of every source column as string, keys in sorted order."""
    names = sorted(columns if columns is not None else source_columns(df))
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[stringify(n, types[n]).alias(n) for n in names])


def metadata_struct(table=TABLE_NAME) -> Column:
    """Change metadata with keys in sorted order."""
    return F.struct(
        lsn_hex(START_LSN).alias("LSN"),
        F.col(OPERATION).alias("OperationID"),
        operation_type(OPERATION).alias("OperationType"),
        lsn_hex(SEQVAL).alias("Seq"),
        _col(table).alias("TableName"),
    )


def change_struct(df: DataFrame, columns: list[str] | None = None) -> Column:
    """``{data, metadata}`` of one change."""
    return F.struct(
        data_struct(df, columns).alias("data"),
        metadata_struct().alias("metadata"),
    )


def to_json_keep_nulls(c) -> Column:
    return F.to_json(_col(c), JSON_KEEP_NULLS)


def raw_record_json(df: DataFrame, exclude=(TABLE_NAME,)) -> Column:
    """JSON of a raw change row in native types, as a sampler would encode it.

    Binary becomes base64; timestamps are written with microseconds.
    """
    names = [f.name for f in df.schema.fields if f.name not in set(exclude)]
    return F.to_json(
        F.struct(*[F.col(q(n)) for n in names]),
        {
            "ignoreNullFields": "false",
            "timeZone": "UTC",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        },
    )
