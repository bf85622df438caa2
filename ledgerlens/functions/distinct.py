"""Several exact distinct counts in one pass, mergeable.

Two ``count(distinct)`` in one aggregate make Spark copy every row once per
distinct column and shuffle the values themselves.  Here a whole-number id
is a bit: its bucket (32,768 ids) and its position there.  Rows are
aggregated to a bitmap per bucket in the map tasks, bitmaps are merged, and
counts are sums of set bits.  The bitmaps can be stored, and merged later over
any groups, which plain counts cannot.  Ids of other types are their own
buckets: the same plan with one row per distinct value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def partials(df: DataFrame, ids: Mapping[str, Column], sums: Mapping[str, Column] | None = None,
             keys: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``keys``, kind of id and bucket: ``kind``,
    ``bucket``, ``bits`` and the sums of ``sums``.

    ``ids`` maps a kind to the id to count, NULL where a row does not count;
    ids of one call are of one type.  Sums stand with the first kind only,
    so adding them up over all rows counts every input row once.
    """
    sums = dict(sums or {})
    typed = df.select(*keys, *[c.alias(f"_id_{k}") for k, c in ids.items()], *[c.alias(f"_sum_{k}") for k, c in sums.items()])
    kinds = {typed.schema[f"_id_{k}"].dataType for k in ids}
    whole = all(isinstance(kind, WHOLE) for kind in kinds)
    if not whole and len(kinds) > 1:
        raise TypeError(f"ids of different types: {sorted(kind.simpleString() for kind in kinds)}")
    rows = []
    for i, k in enumerate(ids):
        c = F.col(f"_id_{k}")
        place = ([F.bitmap_bucket_number(c.cast("long")).alias("bucket"), F.bitmap_bit_position(c.cast("long")).alias("bit")]
                 if whole else [c.alias("bucket"), F.when(c.isNotNull(), F.lit(0).cast("long")).alias("bit")])
        own = [(F.col(f"_sum_{s}") if i == 0 else F.lit(None).cast(typed.schema[f"_sum_{s}"].dataType)).alias(s) for s in sums]
        rows.append(F.struct(F.lit(k).alias("kind"), *place, *own))
    flat = typed.select(*keys, F.inline(F.array(*rows)))
    bits = F.bitmap_construct_agg("bit") if whole else F.max("bit")
    return flat.groupBy(*keys, "kind", "bucket").agg(bits.alias("bits"), *[F.sum(s).alias(s) for s in sums])


def merged(parts: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """``partials`` of several groups as those of the groups of ``keys``."""
    whole = isinstance(parts.schema["bits"].dataType, T.BinaryType)
    bits = F.bitmap_or_agg("bits") if whole else F.max("bits")
    return parts.groupBy(*keys, "kind", "bucket").agg(bits.alias("bits"), *[F.sum(s).alias(s) for s in sums])


def counts(parts: DataFrame, kinds: Sequence[str], keys: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``keys`` (one in all without keys): the distinct ids of each kind, and the sums."""
    whole = isinstance(parts.schema["bits"].dataType, T.BinaryType)
    n = F.bitmap_count("bits") if whole else (F.col("bits") + 1)
    per = [F.coalesce(F.sum(F.when(F.col("kind") == k, n)), F.lit(0)).alias(k) for k in kinds]
    return parts.groupBy(*keys).agg(*per, *[F.sum(s).alias(s) for s in sums])


def distinct_counts(df: DataFrame, ids: Mapping[str, Column], sums: Mapping[str, Column] | None = None,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Exact distinct counts of several ids, and sums, in one pass over ``df``."""
    return counts(partials(df, ids, sums, keys), list(ids), keys, list(sums or {}))
