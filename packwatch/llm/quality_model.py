"""Document quality by Bradley-Terry ranking of preference pairs."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwatch.llm.common import settle, table

RIDGE = 1e-3
STEPS = 25
#: Score at the threshold between the classes.
CUT = 0.7
#: Scores lie on a grid while fitting, each shared out to its two neighbours: nodes for each unit, up to REACH to either side.
PER_UNIT, REACH = 32, 32
NODES = 2 * REACH * PER_UNIT + 1
#: Cells into which values are counted to find one by its rank, and how many values may be collected.
RANK_CELLS, FEW = 1000, 10_000
FEATURES = (
    "log_words", "word_length", "long_words", "symbols", "exclamations", "capitals", "digits", "marks", "variety",
    "stutter", "same_lines", "line_words", "spread", "bytes_per_char",
)
SYMBOLS = frozenset(b"#*$%&|<>~^=\\{}[]@_")
MARKS = frozenset(b".,;:?")

_KIND = np.zeros((6, 256))
for _row, _set in enumerate((SYMBOLS, b"!", range(65, 91), range(48, 58), MARKS, range(97, 123))):
    _KIND[_row, list(_set)] = 1


def features(text: str) -> list[float]:
    """Figures of a whole text, none of which looks at its language or source."""
    data = text.encode("utf-8", "surrogatepass")
    counts = _KIND @ np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    symbols, bangs, capitals, digits, marks, small = counts.tolist()
    words = text.split()
    n = max(len(words), 1)
    different = len(set(words))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    size = sum(map(len, words))
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        math.log1p(len(words)) / 5,
        size / n / 5,
        sum(len(w) > 20 for w in words) / n,
        math.log1p(10 * symbols / n),
        math.log1p(10 * bangs / n),
        capitals / max(capitals + small, 1),
        digits / max(size, 1),
        math.log1p(10 * marks / n),
        # words that differ, against what prose of that length has
        math.log(max(different, 1) / n ** 0.9),
        min(5 * stutter / n, 1.0),
        1 - len(set(lines)) / max(len(lines), 1),
        math.log1p(n / max(len(lines), 1)) / 5,
        abs(size / n - 5) / 5,
        len(data) / max(len(text), 1) - 1,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """Rows (id, features) from (id, text); a null text counts as empty."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(pa.float64()))], ["id", "features"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, features array<double>")


def placed(z: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower node of each row's score, and the share of the upper one."""
    at = (np.clip(z @ w, -REACH, REACH) + REACH) * PER_UNIT
    node = np.minimum(at.astype(np.int64), NODES - 2)
    return node, at - node


def grid_sums(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows and sums of their features by class and node of the score."""
    node, upper = placed(z, w)
    at = np.concatenate([y * NODES + node, y * NODES + node + 1])
    share = np.concatenate([1 - upper, upper])
    sums = [np.bincount(at, share * np.tile(c, 2), 2 * NODES) for c in (np.ones(len(z)), *z.T)]
    return np.stack(sums, axis=1).reshape(2, NODES, -1)


def curvature(z: np.ndarray, y: np.ndarray, w: np.ndarray, by_node: np.ndarray) -> np.ndarray:
    """Sum of z z', each row weighted by what its class has at its score."""
    node, upper = placed(z, w)
    weight = by_node[y, node] * (1 - upper) + by_node[y, node + 1] * upper
    return z.T @ (z * weight[:, None])


def newton(size: int, summed: Callable[[Callable, tuple], np.ndarray]) -> np.ndarray:
    """Weights under which good rows beat bad ones: logistic loss on the differences of all pairs of a good and a bad one.

    ``summed`` adds up a function's result over all rows. A pair's part in the slope depends on both scores only, so
    rows and features summed by score stand for all pairs; the curvature takes another pass.
    """
    w = np.zeros(size)
    ahead = np.arange(1 - NODES, NODES) / PER_UNIT
    lost = 1 / (1 + np.exp(ahead))
    steep = lost * (1 - lost)
    for _ in range(STEPS):
        grid = summed(lambda z, y, w=w: grid_sums(z, y, w), (2, NODES, 1 + size))
        bad, good = grid[0], grid[1]
        pairs = bad[:, 0].sum() * good[:, 0].sum()
        gradient = np.convolve(lost, bad[:, 0], "valid") @ good[:, 1:] - np.convolve(lost[::-1], good[:, 0], "valid") @ bad[:, 1:]
        by_node = np.stack([np.convolve(steep, good[:, 0], "valid"), np.convolve(steep, bad[:, 0], "valid")])
        cross = good[:, 1:].T @ np.stack([np.convolve(steep, c, "valid") for c in bad[:, 1:].T], axis=1)
        hessian = summed(lambda z, y, w=w, by_node=by_node: curvature(z, y, w, by_node), (size, size)) - cross - cross.T
        step = np.linalg.solve(hessian / pairs + RIDGE * np.eye(size), gradient / pairs - RIDGE * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    # sums of floats come in any order
    return np.round(w, 9)


def fit(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The weights of newton() for rows at hand."""
    z, y = np.concatenate([good, bad]), np.repeat([1, 0], [len(good), len(bad)])
    return newton(z.shape[1], lambda work, shape: work(z, y).reshape(shape))


def fit_rows(rows: DataFrame, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """The weights of newton() for rows (label, features), which stay where they are; only sums come to the driver."""

    def summed(work: Callable, shape: tuple) -> np.ndarray:
        def run(batches):
            total = np.zeros(shape)
            for batch in batches:
                x = batch.column("features").flatten().to_numpy().reshape(-1, len(middle))
                total += work((x - middle) / spread, batch.column("label").to_numpy())
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["slot", "value"])

        found = rows.mapInArrow(run, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
        total = np.zeros(math.prod(shape))
        total[found["slot"].to_numpy()] = found["value"].to_numpy()
        return total.reshape(shape)

    return newton(len(middle), summed)


def at_rank(values: DataFrame, rank: int) -> float:
    """The value with so many before it in ascending order, of rows (value)."""
    x = F.col("value")
    low, high = values.agg(F.min(x), F.max(x)).first()
    while low < high:
        cell = F.least(F.floor((x - low) / (high - low) * RANK_CELLS), F.lit(RANK_CELLS - 1)).alias("cell")
        inside = values.where(x.between(low, high))
        for r in sorted(inside.groupBy(cell).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).collect()):
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high = r["low"], r["high"]
        if r["n"] <= FEW:
            return sorted(v for (v,) in inside.where(x.between(low, high)).collect())[rank]
    return low


def quantile(values: DataFrame, count: int, share: float) -> float:
    """The quantile of so many rows (value), linear between neighbours, exact."""
    rank = min(int(share * (count - 1)), count - 1)
    low = at_rank(values, rank)
    part = share * (count - 1) - rank
    return low + (at_rank(values, rank + 1) - low) * part if part else low


def held_out(row: Column) -> Column:
    return F.coalesce(F.crc32(row.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> DataFrame:
    """Rows (id, held_out, score, predicted) of every document.

    Learns from all labelled documents that are not held out, and all pairs of a good and a bad one;
    null labels and ids without a document are left out. Without a document of
    either class all scores are CUT. The threshold is the quantile of the fitted rows' scores at
    their share of bad ones, and has the score CUT. Null and empty texts get the score of an
    empty text; an id that repeats is scored in each row; an empty table gives no rows.

    Texts are read once; their features, some hundred bytes a document, are stored and joined with the labels. The
    fit passes over the stored features of labelled documents; the driver gets sums only.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    found = settle(measured(rows), "text-features")
    known = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    known = settle(found.join(known, "id").select(F.col("label").cast("long").alias("label"), "features"), "text-labelled")
    each = [F.col("features")[i] for i in range(len(FEATURES))]
    count, good, *figures = known.agg(
        F.count("*"), F.sum("label"), *[F.avg(c) for c in each], *[F.stddev_pop(c) for c in each]
    ).first()
    line, cut = F.lit(0.0), 0.0
    if count and 0 < good < count:
        middle, spread = np.split(np.array(figures), 2)
        spread = spread + 1e-9
        w = fit_rows(known, middle, spread) / spread
        line = sum((c * F.lit(v) for c, v in zip(each, w.tolist(), strict=True)), line)
        cut = quantile(known.select(line.alias("value")), count, (count - good) / count)
    raw = line - F.lit(cut) + F.lit(math.log(CUT / (1 - CUT)))
    score = (1 / (1 + F.exp(-F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0))))).alias("score")
    return found.select("id", held_out(F.col("id")).alias("held_out"), score).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )


def scored_documents(spark, folder: str) -> DataFrame:
    """op2: quality score and class of every document."""
    found = scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumnRenamed("id", "doc_id")
