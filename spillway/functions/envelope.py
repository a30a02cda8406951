"""Payload text, work envelope and queue naming (JVM-side column functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the original JSON encoder escapes although JSON
# does not require it, and the escape it writes for each (HTML-safe output).
HTML_SAFE_ESCAPES = (
    ("<", "\\u003c"),
    (">", "\\u003e"),
    ("&", "\\u0026"),
    ("\u2028", "\\u2028"),
    ("\u2029", "\\u2029"),
)


def payload_text(value: Column, binary: bool = False) -> Column:
    """Message value as text: a missing value is the empty string; invalid
    UTF-8 is repaired with U+FFFD instead of failing the job."""
    text = F.make_valid_utf8(value.cast("string")) if binary else value.cast("string")
    return F.coalesce(text, F.lit(""))


def repaired(value: Column) -> Column:
    """True when the binary value was not valid UTF-8 (counted, not dropped)."""
    return F.coalesce(~F.is_valid_utf8(value.cast("string")), F.lit(False))


def envelope(data: Column) -> Column:
    """``{"attempts":1,"data":<text>}`` with the same escaping as the original
    encoder. The escaped characters never occur as JSON syntax, so replacing
    them in the JSON text only touches string content."""
    doc = F.to_json(F.struct(F.lit(1).alias("attempts"),
                             F.coalesce(data, F.lit("")).alias("data")))
    for raw, escaped in HTML_SAFE_ESCAPES:
        doc = F.replace(doc, F.lit(raw), F.lit(escaped))
    return doc


def queue_name(topic: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), topic)
