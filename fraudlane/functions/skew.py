"""Keep rows that can never match a join from piling into one task.

A left (outer or anti) join sends every row whose key is null to the same hash partition,
although none of them can match. ``null_spread`` gives such rows an extra join-key value
hashed from their own content and every row with a key the value 0, so null-keyed rows
scatter over all tasks and still match nothing; rows with a key join as before.

Both sides must compute it from their own columns: a literal 0 on one side would be
folded by the optimizer into a post-join condition, and the spread would vanish from the
exchange keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPREAD = "_null_spread"


def null_spread(keys, content) -> Column:
    """Left-side spread value: a hash of ``content`` when any of ``keys`` is null, else 0."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() if isinstance(k, str) else k.isNull() for k in keys])
    return F.when(missing, F.xxhash64(*content)).otherwise(F.lit(0).cast("long")).alias(SPREAD)
