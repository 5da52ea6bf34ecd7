"""Ordered work per key that holds up when one key owns a large share of all rows.

A plain window over ``partitionBy(vin)`` puts a whole vehicle into one task. So every
operator first measures its keys: one column-pruned count, combined on the map side. If
no key has more than ``hot_rows`` rows, plain windows follow. Otherwise the rows of hot
keys are range-partitioned on key and order and written once; each partition is a slice.
Windows then run per (key, slice), and what a slice needs from its neighbours is carried
over from one summary row per slice.

Range bounds come from a sample of the rows themselves, so outlying times, bursts and
rows without a time leave the slices even. A row without a time is before all others, as
in a plain window. Hot keys are a stored table, which the planner broadcasts only if its
files are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from packwatch.session import settle

HOT_ROWS_SETTING = "spark.packwatch.hotRows"
HOT_ROWS = 4_000_000


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))


def present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all known; a frame without vehicle belongs to no sequence."""
    return df.dropna(subset=list(keys))


def hot_keys(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows and their row count ``n``, if there are any."""
    rows = hot_rows(df)
    counted = (
        present(df, keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), *aggregates)
        .where(F.col("n") > rows)
    )
    found = settle(counted, "hot-keys")
    return None if found.isEmpty() else found


def slices(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    then: Sequence[str] = (),
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Cut hot keys into pieces of about ``hot_rows`` rows, in the order of ``at`` and ``then``.

    Adds ``_hot`` and ``_slice`` if there are hot keys, and nothing otherwise. ``then``
    names the columns that order rows of the same ``at``; without them such rows stay in one
    piece. ``measured_on`` names a frame to measure in place of ``df`` when ``df`` holds the
    same rows and few others.
    """
    df = present(df, keys)
    hot = hot_keys(df if measured_on is None else measured_on, keys)
    if hot is None:
        return df
    pieces = hot.agg(F.sum(F.ceil(F.col("n") / hot_rows(df)))).first()[0] + 1
    dealt = (
        df.join(hot.select(*keys), list(keys), "left_semi")
        .select(*df.columns)
        .repartitionByRange(pieces, *keys, at, *then)
        .withColumn("_slice", F.spark_partition_id().cast("long"))
    )
    # written, as bounds are sampled anew each time that the exchange is computed
    dealt = settle(dealt, "hot-rows").withColumn("_hot", F.lit(True))
    plain = (
        df.join(hot.select(*keys), list(keys), "left_anti")
        .select(*df.columns)
        .withColumns({"_slice": F.lit(-1).cast("long"), "_hot": F.lit(False)})
    )
    return plain.unionByName(dealt).select(*df.columns, "_hot", "_slice")


def is_sliced(df: DataFrame) -> bool:
    return "_slice" in df.columns


def cut_columns(df: DataFrame) -> list[str]:
    """The slicing columns, for operators that pass them on."""
    return ["_hot", "_slice"] if is_sliced(df) else []


def in_slice(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    cut = ["_slice"] if is_sliced(df) else []
    return Window.partitionBy(*keys, *cut).orderBy(*order)


def across(keys: Sequence[str]) -> WindowSpec:
    """Over the slice summaries of a hot key."""
    return Window.partitionBy(*keys).orderBy("_slice")


def _earlier(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], **steps: tuple[str, Column]
) -> DataFrame:
    """Running values per key.

    Each step is ``name=(kind, column)`` with kind ``lag``, ``lead``, ``sum`` (up to and
    including this row), ``last`` (latest non-null value so far) or ``max`` (of the
    earlier rows).
    """
    w, position = in_slice(df, keys, order), F.struct(*order)
    inside, summary, carry, merged = {}, {}, {}, {}
    over = across(keys)
    for name, (kind, c) in steps.items():
        own, other = F.col(f"_in_{name}"), F.col(f"_carry_{name}")
        boxed = F.struct(c.alias("v"))
        if kind == "lag":
            inside[name], summary[name] = F.lag(boxed).over(w), F.max_by(boxed, position)
            carry[name] = F.lag(F.col(name)).over(over)
            merged[name] = F.coalesce(own, other)["v"]
        elif kind == "lead":
            inside[name], summary[name] = F.lead(boxed).over(w), F.min_by(boxed, position)
            carry[name] = F.lead(F.col(name)).over(over)
            merged[name] = F.coalesce(own, other)["v"]
        elif kind == "sum":
            inside[name], summary[name] = F.sum(c).over(_so_far(w)), F.sum(c)
            carry[name] = F.sum(name).over(_earlier(over))
            merged[name] = F.coalesce(own, F.lit(0)) + F.coalesce(other, F.lit(0))
        elif kind == "last":
            inside[name] = F.last(c, ignorenulls=True).over(_so_far(w))
            summary[name] = F.max_by(c, F.when(c.isNotNull(), position))
            carry[name] = F.last(name, ignorenulls=True).over(_earlier(over))
            merged[name] = F.coalesce(own, other)
        elif kind == "max":
            inside[name], summary[name] = F.max(c).over(_earlier(w)), F.max(c)
            carry[name] = F.max(name).over(_earlier(over))
            merged[name] = F.greatest(own, other)
        else:
            raise ValueError(f"unknown step {kind!r}")
    ready = df.withColumns({f"_in_{name}": c for name, c in inside.items()})
    if not is_sliced(df):
        ready = ready.withColumns({f"_carry_{name}": F.lit(None) for name in steps})
        return ready.select(*df.columns, *[c.alias(name) for name, c in merged.items()])
    at = [*keys, "_slice"]
    carried = (
        df.where("_hot")
        .groupBy(*at)
        .agg(*[c.alias(name) for name, c in summary.items()])
        .select(*at, *[c.alias(f"_carry_{name}") for name, c in carry.items()])
    )
    return ready.join(carried, at, "left").select(
        *df.columns, *[c.alias(name) for name, c in merged.items()]
    )


def runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    on: str,
    at: str,
    keep: Sequence[str] = (),
    label: Sequence[str] = (),
) -> DataFrame:
    """Runs of consecutive rows on which the boolean column ``on`` holds.

    Adds ``run_start`` (``at`` of the row that opened the latest run), ``opening``,
    ``closing`` (first row after a run) and ``prev`` (the columns ``on`` and ``keep`` of
    the previous row of the key). The ``label`` columns take the values of the row that
    opened the run, so that they can be grouping keys of the run.
    """
    w, over, position = in_slice(df, keys, order), across(keys), F.struct(*order)
    row, start = F.struct(on, *keep), F.struct(F.col(at).alias("at"), *label)
    # the first row of a hot slice waits for the carry, that of an ordinary key opens
    unknown = ~F.col("_hot") if is_sliced(df) else F.lit(True)
    opens_inside = F.col(on) & F.coalesce(~F.col(f"_prev.{on}"), unknown)
    inner = (
        df.withColumn("_prev", F.lag(row).over(w))
        .withColumn("_opened", F.when(opens_inside, start))
        .withColumn("_run", F.last("_opened", ignorenulls=True).over(_so_far(w)))
    )
    was_on = F.coalesce(F.col(f"prev.{on}"), F.lit(False))
    own = [c for c in df.columns if c not in label]
    run = F.coalesce("_run", "_carry_start")
    found = [
        F.col("prev"),
        run["at"].alias("run_start"),
        *[run[c].alias(c) for c in label],
        (F.col(on) & ~was_on).alias("opening"),
        (~F.col(on) & was_on).alias("closing"),
    ]
    if not is_sliced(df):
        return (
            inner.withColumnRenamed("_prev", "prev")
            .withColumn("_carry_start", F.lit(None))
            .select(*own, *found)
        )
    at_slice = [*keys, "_slice"]
    summary = (
        inner.where("_hot")
        .groupBy(*at_slice)
        .agg(
            F.min_by(on, position).alias("_head_on"),
            F.min_by(start, position).alias("_head_at"),
            F.max_by(row, position).alias("_tail"),
            F.max_by("_opened", F.when(F.col("_opened").isNotNull(), position)).alias("_last_opened"),
        )
        .withColumn("_prev_tail", F.lag("_tail").over(over))
        .withColumn(
            "_head_start",
            F.when(
                F.col("_head_on") & ~F.coalesce(F.col(f"_prev_tail.{on}"), F.lit(False)),
                F.col("_head_at"),
            ),
        )
        .withColumn("_latest", F.coalesce("_last_opened", "_head_start"))
        .select(
            *at_slice,
            "_prev_tail",
            F.coalesce(
                "_head_start", F.last("_latest", ignorenulls=True).over(_earlier(over))
            ).alias("_carry_start"),
        )
    )
    return (
        inner.join(summary, at_slice, "left")
        .withColumn("prev", F.coalesce("_prev", "_prev_tail"))
        .select(*own, *found)
    )


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1-based position of each row within its key."""
    return scan(df, keys, order, **{name: ("sum", F.lit(1).cast("long"))})


def blocks(
    df: DataFrame, position: str, before: int = 0, after: int = 0, size: int | None = None
) -> DataFrame:
    """Cut each key into blocks of ``size`` positions for windows over neighbours.

    The last ``before`` rows of a block are repeated in the next one and its first
    ``after`` rows in the previous one. ``_own`` marks the row in its own block.
    """
    size = max(size or hot_rows(df), before, after, 1)
    zero = F.col(position) - 1
    block, offset = F.floor(zero / size), zero % size
    homes = F.array(
        block,
        F.when(offset >= size - before, block + 1) if before else F.lit(None).cast("long"),
        F.when((offset < after) & (block > 0), block - 1) if after else F.lit(None).cast("long"),
    )
    return (
        df.withColumn("_home", block)
        .withColumn("_block", F.explode(F.array_compact(homes)))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_home")
    )


def in_windows(
    rows: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    disjoint: bool = False,
) -> DataFrame:
    """Rows joined to the windows of their key that contain them, both ends included.

    Times are whole numbers. Windows that overlap no other one need no pairs: each row looks back
    to the latest window opened before it, in one ordered pass. Those that do overlap are cut at each other's
    ends into stretches, in each of which the same windows are open; rows find their stretch in such a pass too,
    and by it their windows. A window makes as many rows as ends of others lie in it, however
    long it is. Windows without a start or end, or ending before they start, contain nothing.
    ``disjoint=True`` states that none overlap.
    """
    extra = [c for c in windows.columns if c not in keys]
    if disjoint:
        return _latest_window(rows, windows, keys, at, start, end, extra)
    windows = windows.where(F.col(start) <= F.col(end))
    marked = scan(
        slices(windows, keys, start, [end]),
        keys,
        [start, end],
        _before=("max", F.col(end)),
        _after=("lead", F.col(start)),
    )
    alone = (F.coalesce(F.col("_before") < F.col(start), F.lit(True))) & (
        F.coalesce(F.col("_after") > F.col(end), F.lit(True))
    )
    single = marked.where(alone).select(*windows.columns)
    shared = marked.where(~alone).select(*windows.columns)
    stretches, opened = _stretches(shared, keys, start, end)
    placed = _latest_window(rows, stretches, keys, at, "_from", "_to", ["_from", "_to", "_stretch"])
    matched = placed.join(opened, [*keys, "_stretch"]).select(*rows.columns, *extra)
    return _latest_window(rows, single, keys, at, start, end, extra).unionByName(matched)


def _stretches(windows, keys, start, end):
    """Between all ends of a key's windows: stretches (_from, _to, _stretch), and the windows open in each."""
    after = F.least(F.col(end).cast("long"), F.lit((1 << 63) - 2)) + 1
    begin = F.col(start).cast("long")
    ends = windows.select(*keys, F.explode(F.array(begin, after)).alias("_from")).distinct()
    cut = slices(ends, keys, "_from")
    numbered = positions(cut, keys, ["_from"], "_stretch").drop(*cut_columns(cut))
    numbered = settle(numbered.select(*keys, "_from", "_stretch"), "window-ends")
    following = numbered.select(*keys, (F.col("_stretch") - 1).alias("_stretch"), (F.col("_from") - 1).alias("_to"))
    first = numbered.select(*keys, F.col("_from").alias("_begin"), F.col("_stretch").alias("_first"))
    last = numbered.select(*keys, F.col("_from").alias("_after"), F.col("_stretch").alias("_last"))
    opened = (
        windows.withColumns({"_begin": begin, "_after": after})
        .join(first, [*keys, "_begin"])
        .join(last, [*keys, "_after"])
        .withColumn("_stretch", F.explode(F.sequence(F.col("_first"), F.col("_last") - 1)))
        .drop("_begin", "_after", "_first", "_last")
    )
    return numbered.join(following, [*keys, "_stretch"]), opened


def _latest_window(rows, windows, keys, at, start, end, extra):
    markers = windows.select(
        *keys,
        F.col(start).alias(at),
        F.lit(0).alias("_kind"),
        F.struct(*extra).alias("_window"),
    )
    mixed = rows.withColumn("_kind", F.lit(1)).unionByName(markers, allowMissingColumns=True)
    cut = slices(mixed, keys, at, ["_kind"], measured_on=rows)
    seen = scan(cut, keys, [at, "_kind"], _open=("last", F.col("_window")))
    return seen.where((F.col("_kind") == 1) & (F.col(at) <= F.col(f"_open.{end}"))).select(
        *rows.columns, *[F.col(f"_open.{c}").alias(c) for c in extra]
    )
