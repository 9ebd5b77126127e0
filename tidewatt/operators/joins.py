"""Star-schema joins.

No size is assumed for a dimension: Spark broadcasts it only if its measured size is under
spark.sql.autoBroadcastJoinThreshold (again at run time with AQE), and otherwise sorts and
merges, with AQE splitting a partition that one hot key blows up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def look_up(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, columns: Sequence[str]) -> DataFrame:
    """LEFT join of chosen dimension columns; the dimension must be unique on the key."""
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(dim.select(*keys, *columns), keys, "left")


def only_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is among keys, which may repeat; put before a grouping by the key, it leaves out whole groups."""
    return df.join(keys.select(*on), list(on), "left_semi")


def look_up_seed(df: DataFrame, seed: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Join to a seed. Seeds are constants of this package (under 200 rows), so broadcast is safe."""
    return df.join(F.broadcast(seed), on, how)


def with_matched_flag(left: DataFrame, right: DataFrame, keys: Sequence[str], unmatched: str) -> DataFrame:
    """LEFT join plus a flag for rows without a partner."""
    tagged = right.withColumn("_hit", F.lit(True))
    joined = left.join(tagged, list(keys), "left")
    return joined.withColumn(unmatched, F.col("_hit").isNull()).drop("_hit")


def missing_from(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(actual.select(*keys), list(keys), "left_anti")


def recent_ids(df: DataFrame, key: str, ts: str, n: int) -> DataFrame:
    """The n ids with the newest timestamp."""
    last = df.groupBy(key).agg(F.max(ts).alias("_ts"))
    return last.orderBy(F.col("_ts").desc_nulls_last(), F.col(key)).limit(n).select(key)


# Buckets of the digests of compare: their tables, and what is broadcast, have at most so many rows.
BUCKETS = 4096


def _hashed(df: DataFrame) -> DataFrame:
    # Nulls are told apart from values by flags, because hashes pass over nulls.
    values = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    row = F.xxhash64(*values)
    return df.select("*", row.alias("_row"), F.hash(*values).cast("long").alias("_more"), F.pmod(row, F.lit(BUCKETS)).alias("_bucket"))


def _digests(df: DataFrame, side: str) -> DataFrame:
    """Per bucket of equal row hashes: count and sums of two hashes, whatever the order of rows."""
    parts = F.struct(F.count(F.lit(1)), F.sum(F.col("_row").cast("decimal(20,0)")), F.sum(F.col("_more")))
    return df.groupBy("_bucket").agg(parts.alias(side))


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one result but not the other, with multiplicity and side; empty means equal.

    Buckets of rows are compared by their digests first; only rows of buckets that differ are shuffled, both sides at
    once. A column may hold nulls; maps cannot be compared.
    """
    columns = a.columns
    left, right = _hashed(a), _hashed(b.select(*[f"`{c}`" for c in columns]))
    digests = _digests(left, "_left").join(_digests(right, "_right"), "_bucket", "full_outer")
    differ = F.broadcast(digests.filter(~F.col("_left").eqNullSafe(F.col("_right"))).select("_bucket"))  # BUCKETS rows at most
    rows = [df.join(differ, "_bucket", "left_semi").select(*[f"`{c}`" for c in columns], F.lit(sign).alias("_sign"))
            for df, sign in ((left, 1), (right, -1))]
    surplus = rows[0].unionByName(rows[1]).groupBy(*[f"`{c}`" for c in columns]).agg(F.sum("_sign").alias("_n")).filter("_n <> 0")
    side = F.when(F.col("_n") > 0, "left").otherwise("right").alias("side")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n")))
    return surplus.select(*[f"`{c}`" for c in columns], side, copies.alias("_copy")).drop("_copy")
