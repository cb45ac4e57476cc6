"""Joins that stay splittable when one key is hot.

Adaptive execution splits a hot key only where both inputs of a join come
straight from a shuffle. The output of an aggregate or window is already
partitioned by its key, so Spark joins it without another shuffle and could not
split the other input. Comparing the keys as one struct makes Spark shuffle both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_struct(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` (left name -> right name); null keys are equal to each other."""
    ours = F.struct(*[left[k].alias(f"k{i}") for i, k in enumerate(keys)])
    theirs = F.struct(*[right[k].alias(f"k{i}") for i, k in enumerate(keys.values())])
    return left.join(right, ours == theirs, how)
