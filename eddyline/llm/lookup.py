"""Looking counts up for the items of many documents without shuffling the frequent ones.

A table (item, count) of all distinct items may grow with the corpus. Its most frequent items, at most `HEAD` of them, are handed to the tasks; they
cover most occurrences. All others are joined by a shuffle. None of those can be hot: an item outside the head occurs in fewer documents than
each of the head's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD = 1 << 18  # items; of at most 65 bytes each


def head_from(items: DataFrame, count: str, limit: int = HEAD) -> int:
    """The least power of two such that at most `limit` items have that count or more. Needs one row per power of two on the driver."""
    power = F.floor(F.log2(F.col(count))).cast("int")
    sizes = dict(items.where(F.col(count) > 0).groupBy(power.alias("power")).count().collect())
    total, least = 0, 63
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > limit:
            break
        least = p
    return 1 << least


def in_head(count: str, least: int) -> Column:
    return F.floor(F.log2(F.col(count))) >= (least.bit_length() - 1)
