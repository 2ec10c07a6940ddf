"""Column functions: wire encodings and the window key format."""

from soleprint.functions.encoding import (
    decode_long,
    encode_long,
    json_envelope,
    window_key,
    windowed_key_bytes,
)

__all__ = ["decode_long", "encode_long", "json_envelope", "window_key", "windowed_key_bytes"]
