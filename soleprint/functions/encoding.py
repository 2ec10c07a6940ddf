"""Wire encodings as built-in expressions, so they stay in generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A JSON message is one zero byte, a 4-byte schema id, then UTF-8 text.
MAGIC_HEX = "00"
PREFIX_BYTES = 5


def encode_long(n: Column) -> Column:
    """A LONG as 8 bytes, big-endian."""
    return F.unhex(F.lpad(F.hex(n), 16, "0"))


def decode_long(value: Column) -> Column:
    """The non-negative LONG in 8 big-endian bytes; null for any other length."""
    return F.when(F.octet_length(value) == 8, F.conv(F.hex(value), 16, 10).cast("long"))


def json_envelope(row: Column, schema_id: int) -> Column:
    """A struct as a schema-registry JSON message."""
    prefix = MAGIC_HEX + format(schema_id, "08X")
    return F.concat(F.unhex(F.lit(prefix)), F.to_json(row).cast("binary"))


def _instant(ts: Column) -> Column:
    """ISO-8601 UTC instant, with a fraction only where there is one, in groups of 3 digits.

    Going through a timestamp without zone keeps the text free of the session time zone.
    """
    micros = F.unix_micros(ts)
    fraction = F.pmod(micros, F.lit(1_000_000))
    digits = F.lpad(fraction.cast("string"), 6, "0")
    tail = (
        F.when(fraction == 0, F.lit(""))
        .when(F.pmod(fraction, F.lit(1000)) == 0, F.concat(F.lit("."), F.left(digits, F.lit(3))))
        .otherwise(F.concat(F.lit("."), digits))
    )
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    utc = F.timestamp_add("MICROSECOND", micros, epoch).cast("string")
    return F.concat(F.translate(F.left(utc, F.lit(19)), " ", "T"), tail, F.lit("Z"))


def window_key(key: Column, start: Column, end: Column) -> Column:
    """``[key@start/end]`` with ISO-8601 UTC bounds."""
    return F.concat(F.lit("["), key, F.lit("@"), _instant(start), F.lit("/"), _instant(end), F.lit("]"))


def windowed_key_bytes(key: Column, start: Column) -> Column:
    """The binary windowed key: key bytes, then the window start in milliseconds, 8 bytes."""
    return F.concat(key.cast("binary"), encode_long(F.unix_millis(start)))
