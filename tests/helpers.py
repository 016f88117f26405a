import hashlib
import json
import math
from decimal import Decimal


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def digest(rows, cols):
    """Order-insensitive hash of rows, columns taken in name order."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def assert_same_rows(a, b):
    """Two DataFrames hold the same multiset of rows (exceptAll both ways)."""
    assert sorted(a.columns) == sorted(b.columns), (a.columns, b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0
