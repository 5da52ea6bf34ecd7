"""Lines are filed under as few word pairs as find every line of the least similarity."""

import random

import pytest

pytest.importorskip("packwatch.llm")

from packwatch.llm import line_dedup  # noqa: E402


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklm") for _ in range(7)) for _ in range(n)]


def test_word_pairs_of_a_line(spark):
    rows = spark.createDataFrame([(" ".join(words(n, n)),) for n in range(4, 46)], "text string")
    counts = {r.n: r["count"] for r in line_dedup.prefixes(rows, bytes(line_dedup.RANK_CELLS)).groupBy("n").count().collect()}
    assert counts == {n: min(n - 1, 2 * (n // 5) + (n % 5 == 4) + 1) for n in range(4, 46)}


def test_most_words_put_in_left_out_or_exchanged(spark):
    rows, wanted = [], {}
    for n in range(4, 31):
        base = words(100 + n, n)
        most = max(m - n for m in range(n, 2 * n) if m - n <= m // 5)
        put_in = list(base)
        for k in range(most):
            put_in.insert(1 + k * 2 + k * (n - 2) // max(most, 1) // 2, f"put{n}x{k}")
        d = n // 5
        spots = {1 + k * n // max(d, 1) for k in range(d)}
        exchanged = [f"new{n}x{i}" if i in spots else w for i, w in enumerate(base)]
        for k, line in enumerate([base, put_in, exchanged]):
            rows.append((10 * n + k, " ".join(line)))
            # an unchanged line repeats the first one, too
            wanted[10 * n + k] = int(k > 0)
    found = line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.record.doc_id: r.n_dropped for r in found} == wanted
