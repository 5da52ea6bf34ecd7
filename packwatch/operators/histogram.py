"""Zero-filled histograms over a fixed domain, as one ordered array per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the histogram domains
CELLS = (1, 96)
CURRENT_BUCKETS = (0, 30)
CURRENT_STEP = 5

Merge = Callable[[Column], Column]


def filled_histograms(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    domain: tuple[int, int],
    totals: Mapping[str, tuple[Merge, Column]] | None = None,
) -> DataFrame:
    """One array of counts per named integer value, an entry for each number of ``domain``.

    Values outside the domain and NULLs are not counted, yet their keys appear. Rows are
    counted per (key, number) on the map side first; only the counts, at most one per
    number of the domain, come together per key. ``totals`` names further aggregates of
    the key that are made in the same pass: a function that also merges its own results
    (``F.sum``, ``F.max``, ...) and the column it takes.
    """
    totals = totals or {}
    low, high = domain
    pairs = F.array(
        *[
            F.struct(
                F.lit(number).alias("name"),
                F.when(c.between(low, high), c.cast("int")).alias("bucket"),
            )
            for number, c in enumerate(values.values())
        ]
    )
    # every row appears once per value; the totals take the first one
    once = F.col("_p.name") == 0
    counted = (
        df.select(*keys, *[c.alias(name) for name, (_, c) in totals.items()], F.explode(pairs).alias("_p"))
        .groupBy(*keys, F.col("_p.name").alias("_name"), F.col("_p.bucket").alias("_bucket"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[merge(F.when(once, F.col(name))).alias(name) for name, (merge, _) in totals.items()],
        )
    )
    entry = F.struct("_bucket", "_n")
    counts = [
        F.map_from_entries(
            F.collect_list(
                F.when((F.col("_name") == number) & F.col("_bucket").isNotNull(), entry)
            )
        ).alias(name)
        for number, name in enumerate(values)
    ]
    merged = [merge(F.col(name)).alias(name) for name, (merge, _) in totals.items()]
    spread = [_spread(F.col(name), low, high).alias(name) for name in values]
    return counted.groupBy(*keys).agg(*counts, *merged).select(*keys, *totals, *spread)


def _spread(counts: Column, low: int, high: int) -> Column:
    return F.transform(
        F.sequence(F.lit(low), F.lit(high)),
        lambda i: F.coalesce(F.element_at(counts, i), F.lit(0).cast("long")),
    )


def array_text(c: Column | str) -> Column:
    """``[1, 2]`` -> ``"1,2"``."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
