"""Types of vectorised functions, without a running session."""

from __future__ import annotations

from pyspark.sql import types as T

_PLAIN = {"double": T.DoubleType(), "string": T.StringType(), "long": T.LongType(), "binary": T.BinaryType(), "int": T.IntegerType()}


def kind(text: str) -> T.DataType:
    """``double``, ``array<double>`` or ``name type, name type``."""
    text = text.strip()
    if text in _PLAIN:
        return _PLAIN[text]
    if text.startswith("array<") and text.endswith(">") and " " not in text:
        return T.ArrayType(kind(text[6:-1]))
    return T.StructType([T.StructField(name, kind(of)) for name, of in (part.split() for part in text.split(","))])
