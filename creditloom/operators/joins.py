"""Joins and reductions shaped for keys that may hold a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.sources.schemas import KEYS


def one_per_key(df: DataFrame, keys=tuple(KEYS)) -> DataFrame:
    """One row per key: the smallest under the order of all other columns, NULLs first.

    A minimum of a struct combines before the shuffle, so copies of a key never meet in one task,
    unlike ``row_number`` over the key.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def many_to_one(many: DataFrame, one: DataFrame, keys=tuple(KEYS), how: str = "inner") -> DataFrame:
    """Join rows to the single row of their key when some keys hold very many rows of ``many``.

    The key is packed into one struct.  Both sides then get an exchange of their own for this join,
    even if ``one`` comes out of joins or aggregates on the same keys, and adaptive execution can
    split the partition of a hot key across tasks.
    """
    packed = F.struct(*[F.col(k) for k in keys]).alias("_key")
    left_rest = [c for c in many.columns if c not in keys]
    right_rest = [c for c in one.columns if c not in keys]
    left = many.select(packed, *[F.col(f"`{c}`") for c in left_rest])
    right = one.select(packed, *[F.col(f"`{c}`") for c in right_rest])
    joined = left.join(right, "_key", how)
    return joined.select("_key.*", *[F.col(f"`{c}`") for c in left_rest + right_rest])
