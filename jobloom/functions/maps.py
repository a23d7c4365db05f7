"""String maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def map_upsert(old: Column, new: Column, unset: list[str] | None = None) -> Column:
    """`old` with the entries of `new` set and the `unset` keys removed."""
    gone = F.map_keys(new)
    if unset:
        gone = F.array_union(gone, F.array(*[F.lit(k) for k in unset]))
    kept = F.map_filter(
        F.coalesce(old, F.map_from_arrays(F.array().cast("array<string>"),
                                          F.array().cast("array<string>"))),
        lambda k, _: ~F.array_contains(gone, k),
    )
    return F.map_concat(kept, new)
