"""Output-schema expressions such as ``"*, margin_tier:str"``.

``*`` stands for every input field in order; ``name:type`` appends (or, if
the name exists, replaces in place) a field. Type names are the short forms
used in schema hints plus any Spark DDL type name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_SIMPLE = {
    "str": T.StringType(), "string": T.StringType(),
    "int": T.IntegerType(), "integer": T.IntegerType(),
    "long": T.LongType(), "bigint": T.LongType(),
    "short": T.ShortType(), "smallint": T.ShortType(),
    "byte": T.ByteType(), "tinyint": T.ByteType(),
    "double": T.DoubleType(), "float": T.FloatType(),
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(), "bytes": T.BinaryType(),
}
_DECIMAL = re.compile(r"^decimal\((\d+)\s*,\s*(\d+)\)$")


def parse_type(name: str) -> T.DataType:
    key = name.strip().lower()
    if key in _SIMPLE:
        return _SIMPLE[key]
    m = _DECIMAL.match(key)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    raise ValueError(f"unknown type in schema expression: {name!r}")


def _split_top_level(expr: str) -> list[str]:
    parts, depth, cur = [], 0, []
    for ch in expr:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            parts.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    parts.append("".join(cur))
    return [p.strip() for p in parts if p.strip()]


def schema_of(source, expr: str) -> T.StructType:
    """Resolve a schema expression against ``source`` (DataFrame or StructType)."""
    base = source.schema if isinstance(source, DataFrame) else source
    fields: list[T.StructField] = []
    for item in _split_top_level(expr):
        if item == "*":
            fields.extend(base.fields)
            continue
        if ":" not in item:
            raise ValueError(f"expected name:type, got {item!r}")
        name, typ = (s.strip() for s in item.split(":", 1))
        new = T.StructField(name, parse_type(typ), True)
        idx = next((i for i, f in enumerate(fields) if f.name == name), None)
        if idx is None:
            fields.append(new)
        else:
            fields[idx] = new
    return T.StructType(fields)
