"""The model flags as SQL functions over arrays: signal in, ``'1'``, ``'0'`` or NULL out.

They serve short signals that are already arrays, such as the last ten sessions of a
vehicle. Long signals go through the grouped models in ``operators.models``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _mean(a: str) -> str:
    return f"(aggregate({a}, 0D, (t, v) -> t + v) / size({a}))"


def _total(a: str) -> str:
    return f"aggregate({a}, 0D, (t, v) -> t + v)"


def _dot(a: str, b: str) -> str:
    return _total(f"zip_with({a}, {b}, (p, q) -> p * q)")


def _centred(a: str) -> str:
    return _let("mid", _mean(a), f"transform({a}, c -> c - mid)")


def _steps(a: str) -> str:
    """Absolute changes between neighbours."""
    return f"zip_with(slice({a}, 2, size({a})), slice({a}, 1, size({a}) - 1), (n, p) -> abs(n - p))"


def _slope(x: str, y: str) -> str:
    body = f"try_divide({_dot('dx', _centred(y))}, {_dot('dx', 'dx')})"
    return _let("dx", _centred(x), body)


def _flag(condition: str) -> str:
    return f"CASE WHEN coalesce({condition}, false) THEN '1' ELSE '0' END"


def _smooth(a: str, win: str) -> str:
    half = f"least({win}, i, size({a}) - 1 - i)"
    return (
        f"transform(sequence(0, size({a}) - 1), i -> "
        f"sort_array(slice({a}, i - {half} + 1, 2 * {half} + 1))[{half}])"
    )


def _quartile(a: str, quarter: int) -> str:
    """Quartile of a sorted array."""
    at = f"((size({a}) + 1) * {quarter} / 4)"
    k, f = f"cast(floor({at}) AS int)", f"({at} % 1)"
    return f"({a}[{k} - 1] * (1 - {f}) + coalesce(get({a}, {k}), 0D) * {f})"


def _beyond_box(a: str, factor: str) -> str:
    box = f"named_struct('q1', {_quartile('sorted', 1)}, 'q3', {_quartile('sorted', 3)})"
    reach = f"((box.q3 - box.q1) * {factor})"
    test = f"exists(sorted, v -> v < box.q1 - {reach} OR v > box.q3 + {reach})"
    return _let("sorted", f"sort_array({a})", f"size(sorted) >= 3 AND {_let('box', box, test)}")


def _impedance(spread: str, current: str, slow: str, fast: str) -> str:
    both = f"zip_with({spread}, {current}, (s, i) -> named_struct('s', s, 'i', abs(i), 'on', i < -5))"
    ratio = _mean("transform(pairs, z -> z.s / z.i)")
    strength = "transform(pairs, z -> z.i)"
    mean, peak = _mean(strength), f"array_max({strength})"
    fast_charge = f"({mean} >= 50 OR ({mean} > 30 AND {peak} > 50))"
    test = f"size(pairs) > 0 AND {ratio} >= CASE WHEN {fast_charge} THEN {fast} ELSE {slow} END"
    bound = _let("pairs", f"filter({both}, z -> z.on)", test)
    return _flag(f"size({spread}) > 50 AND {bound}")


def _fluctuation(high: str, low: str, th: str) -> str:
    x, y = _total(_steps(high)), _total(_steps(low))
    return _flag(
        f"size({high}) > 1 AND greatest({x}, {y}) > 0 "
        f"AND {_mean(f'concat({_steps(high)}, {_steps(low)})')} > 0.005 "
        f"AND least({x}, {y}) / greatest({x}, {y}) < {th}"
    )


def _dispersion(frames: str, th1: str, th2: str) -> str:
    parsed = f"transform({frames}, s -> from_json(s, 'array<double>'))"
    shifted = f"transform({parsed}, r -> {_centred('r')})"
    by_cell = "transform(sequence(0, size(rows[0]) - 1), j -> transform(rows, r -> r[j]))"
    means = f"transform(cells, c -> abs({_mean('c')}))"
    squares = _let("d", _centred("e"), _dot("d", "d"))
    stds = f"transform(cells, e -> sqrt(try_divide({squares}, size(e) - 1)))"
    test = f"{_beyond_box(means, th1)} OR {_beyond_box(stds, th2)}"
    return _flag(_let("rows", shifted, _let("cells", by_cell, test)))


def _empty(*arrays: str) -> str:
    return " OR ".join(f"{a} IS NULL OR size({a}) = 0" for a in arrays)


DEFINITIONS = {
    "charge_vol_diff_exp": (
        "vol_diff ARRAY<DOUBLE>, day_diff ARRAY<DOUBLE>",
        _flag(
            f"{_slope('day_diff', 'vol_diff')} > 0.05 "
            "AND array_max(day_diff) - array_min(day_diff) > 40"
        ),
    ),
    "conn_impedance": (
        "spread ARRAY<DOUBLE>, cur ARRAY<DOUBLE>, soc ARRAY<DOUBLE>, rth1 DOUBLE, rth2 DOUBLE",
        _impedance("spread", "cur", "rth1", "rth2"),
    ),
    "r_reduce": (
        "signal ARRAY<DOUBLE>, th INT, win INT",
        f"CASE WHEN {_empty('signal')} THEN NULL WHEN size(signal) < 2 THEN '0' ELSE "
        + _flag(
            _let(
                "s",
                _smooth("signal", "win"),
                "exists(zip_with(slice(s, 2, size(s)), slice(s, 1, size(s) - 1), (n, p) -> n - p), "
                "d -> d < -th)",
            )
        )
        + " END",
    ),
    # the score of this model is not defined; it answers NULL for every signal
    "bms_sampling": (
        "high_cells ARRAY<INT>, low_cells ARRAY<INT>, spread DOUBLE",
        "CAST(NULL AS STRING)",
    ),
    "vol_fluctuation": (
        "high ARRAY<DOUBLE>, low ARRAY<DOUBLE>, th DOUBLE",
        f"CASE WHEN {_empty('high', 'low')} THEN NULL ELSE {_fluctuation('high', 'low', 'th')} END",
    ),
    "cell_vol_high_dis": (
        "frames ARRAY<STRING>, th1 INT, th2 INT",
        f"CASE WHEN {_empty('frames')} THEN NULL ELSE {_dispersion('frames', 'th1', 'th2')} END",
    ),
}


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL in this session."""
    for name, (arguments, body) in DEFINITIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS STRING RETURN {body}"
        )


def slope(x: str, y: str) -> str:
    """SQL text of the least-squares slope of array ``y`` over array ``x``."""
    return _slope(x, y)
