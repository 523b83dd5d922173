"""Numbers and ranks inside keys, without bringing a key's rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.runtime import stage


def number_within(df: DataFrame, key: str, spread: list[str], name: str, buckets: int = 256) -> DataFrame:
    """Add `name`: 0, 1, 2 ... within each value of `key` (null is a value).

    Rows of a key are dealt into `buckets` by a hash of `spread`; bucket sizes
    give each bucket its first number, and only a bucket's rows are sorted in
    one task. A key that holds a third of all rows is thus numbered by many
    tasks. Rows equal in `spread` share a bucket and get different numbers.
    """
    b, base = "__bucket", "__base"
    dealt = df.withColumn(b, F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(key, b).count()
    before = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col(key).alias("__k"), F.col(b).alias("__b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy(key, b).orderBy(*spread)
    out = dealt.join(first, dealt[key].eqNullSafe(first["__k"]) & (dealt[b] == first["__b"]))
    return out.withColumn(name, F.col(base) + F.row_number().over(inside) - 1).drop(b, "__k", "__b", base)


def ranked_within(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Add `name`: the rows of the same `key` (null is a value) that come before in `order`; ties have one rank.

    Rows are dealt into ranges of (key, order), so a key with any share of the
    rows is ranked by many tasks; only rows equal in both stay together. The
    range of a row is written down, as its bounds are drawn anew in each run.
    """
    at, base = "__range", "__base"
    dealt = stage(df.repartitionByRange(key, *order).withColumn(at, F.spark_partition_id()), "ranges")
    before = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy(key, at).count().select(F.col(key).alias("__k"), F.col(at).alias("__r"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base))
    out = dealt.join(first, dealt[key].eqNullSafe(first["__k"]) & (dealt[at] == first["__r"]))
    inside = Window.partitionBy(key, at).orderBy(*order)
    return out.withColumn(name, F.col(base) + F.rank().over(inside) - 1).drop(at, "__k", "__r", base)
