"""Decoding log records: typed rows go on, bad ones are set aside with a reason.

All of it is built-in expressions on one row, so it works alike on batches and streams, and
one bad record never fails the job.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soleprint.functions.encoding import MAGIC_HEX, PREFIX_BYTES

_CORRUPT = "_corrupt"


def decode_records(records: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Add ``payload`` (a struct of ``schema``) and ``reason`` (null for a good record).

    Reasons: ``null_value``, ``bad_envelope``, ``bad_encoding``, ``malformed_json``,
    ``wrong_type``, ``unknown_field`` and, with ``strict``, ``missing_field``. Without
    ``strict`` a missing field is null, as the schemas' required list is then not enforced.
    """
    parsed_schema = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    known = ", ".join(f"'{name}'" for name in schema.names)
    missing = " OR ".join(f"_parsed.{name} IS NULL" for name in schema.names)

    text = f"try_validate_utf8(CAST(substring(value, {PREFIX_BYTES + 1}) AS STRING))"
    # Text that is no object is not parsed again: its fields would all be null.
    parsed = F.struct(
        F.from_json(F.expr("IF(_keys IS NULL, NULL, _text)"), parsed_schema, options)
        .alias("_parsed"))
    reason = f"""CASE
        WHEN value IS NULL THEN 'null_value'
        WHEN octet_length(value) <= {PREFIX_BYTES} OR substring(value, 1, 1) <> X'{MAGIC_HEX}'
          THEN 'bad_envelope'
        WHEN _text IS NULL THEN 'bad_encoding'
        WHEN trim(_text) = 'null' THEN 'null_value'
        WHEN _keys IS NULL THEN 'malformed_json'
        WHEN _parsed IS NULL OR _parsed.{_CORRUPT} IS NOT NULL THEN 'wrong_type'
        WHEN size(array_except(_keys, array({known}))) > 0 THEN 'unknown_field'
        {f"WHEN {missing} THEN 'missing_field'" if strict else ""}
        END AS reason"""
    fields = ", ".join(f"_parsed.{name}" for name in schema.names)
    keyed = records.selectExpr("*", f"{text} AS _text").selectExpr(
        "*", "json_object_keys(_text) AS _keys")
    return once(keyed, parsed).selectExpr(
        *[f"`{name}`" for name in records.columns], reason, f"struct({fields}) AS payload")


def once(df: DataFrame, row: Column) -> DataFrame:
    """Add the fields of the struct ``row``, computed once per row.

    Each later use of a column is otherwise a copy of its expression: filters are pushed below
    it, and a record would be parsed again for every condition on it. A generator of one row is
    a boundary that copies do not cross.
    """
    return df.select("*", F.inline(F.array(row)))


def good_records(decoded: DataFrame) -> DataFrame:
    """The payload fields of the good records.

    The record's own time is the event time and keeps the name ``ts``; the payload's field of
    that name, plain data without a unit, is ``payload_ts``.
    """
    fields = decoded.schema["payload"].dataType.names
    return decoded.where(F.col("reason").isNull()).select(
        F.col("key").cast("string").alias("record_key"), "partition", "offset",
        *[F.col(f"payload.{name}").alias("payload_ts" if name == "ts" else name) for name in fields],
        F.col("timestamp").alias("ts"),
    )


def quarantined(decoded: DataFrame) -> DataFrame:
    """The bad records, bytes unchanged, with the reason."""
    return decoded.where(F.col("reason").isNotNull()).drop("payload")


def violations(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records that break the schema: required fields and closed objects both enforced."""
    return quarantined(decode_records(records, schema, strict=True))
