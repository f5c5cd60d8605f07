from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name in halves, so that the plan is as deep as the logarithm of the parts; one part at least."""
    if not parts:
        raise ValueError("nothing to union")
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return union_all(parts[:middle]).unionByName(union_all(parts[middle:]))
