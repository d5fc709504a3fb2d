from pyspark.sql import Column
from pyspark.sql import functions as F

_SHARED: dict = {}


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def shared(key, build):
    """A fixed literal Column (lookup map, token list, label array) built once
    per JVM and reused: expressions are immutable, and rebuilding a large
    literal costs one driver round trip per element on every plan."""
    from pyspark import SparkContext
    gw = getattr(SparkContext, "_gateway", None)
    k = (id(gw) if gw is not None else None, key)
    if k not in _SHARED:
        _SHARED[k] = build()
    return _SHARED[k]


def lit_array(values) -> Column:
    """``array(lit(v), ...)`` for a fixed tuple of values, shared."""
    values = tuple(values)
    return shared(("array", values), lambda: F.array(*[F.lit(v) for v in values]))


def lit_map(pairs) -> Column:
    """``map(lit(k), lit(v), ...)`` for fixed pairs, shared."""
    pairs = tuple(pairs)
    return shared(("map", pairs), lambda: F.create_map(*[F.lit(x) for kv in pairs for x in kv]))
