"""Settlement-point classification by name.

The rules are literal substring tests checked in order (first match wins).
``_`` is matched literally, so ``HBX1`` is not a hub.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (substring, class) in precedence order, and the default class.
POINT_RULES: tuple[tuple[str, str], ...] = (
    ("HB_", "Hub"),
    ("LZ_", "Load Zone"),
    ("ZONE", "Load Zone"),
)
DEFAULT_POINT_CLASS = "Resource Node"


def classify_point(name, rules=POINT_RULES, default: str = DEFAULT_POINT_CLASS) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    expr = None
    for needle, label in rules:
        cond = c.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)
