"""Text payloads: base64 and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import whole_div

_WHOLE_JSON = r'(?s)^\s*(\{.*\}|\[.*\]|".*"|-?\d[\d.eE+-]*|true|false|null)\s*$'


def _unspaced(text: Column, use) -> Column:
    """``use`` of the text without white space, which few texts have."""
    return F.when(text.rlike(r"\s"), use(F.regexp_replace(text, r"\s", ""))).otherwise(use(text))


def decode_bytes(text: Column) -> Column:
    """Base64 text (white space ignored) → bytes; NULL if it is not valid base64."""
    return F.try_to_binary(_unspaced(text, lambda t: t), F.lit("base64"))


def decoded_length(text: Column) -> Column:
    """Bytes that base64 text stands for, without decoding it."""
    def count(t: Column) -> Column:
        return whole_div(F.octet_length(F.rtrim(t, F.lit("="))) * 3, 4).cast("int")

    return _unspaced(text, count)


def decode_text(text: Column) -> Column:
    """Base64 text → UTF-8 text."""
    return decode_bytes(text).cast("string")


def encode_text(value: Column, line: int = 0) -> Column:
    """Text or bytes → base64, in lines of ``line`` characters when set."""
    flat = F.regexp_replace(F.base64(value.cast("binary")), r"\s", "")
    return F.regexp_replace(flat, rf"(.{{{line}}})(?=.)", "$1\n") if line else flat


def json_text(text: Column) -> Column:
    """Base64 JSON payload → JSON text; NULL unless it is valid JSON."""
    decoded = decode_text(text)
    # the parser stops after one value, so what follows it is ruled out by the shape of the text
    return F.when(decoded.rlike(_WHOLE_JSON) & F.try_parse_json(decoded).isNotNull(), decoded)
