"""Line dedup finds every line of the least similarity, and fails on no row."""

import random

import pytest

pytest.importorskip("packwatch.llm")

from packwatch.llm import line_dedup  # noqa: E402


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklm") for _ in range(6)) for _ in range(n)]


def edited(line: list[str], edits: int, seed: int) -> list[str]:
    """The line with so many words exchanged, left out or put in, spread over it."""
    r, out = random.Random(seed), list(line)
    for k, at in enumerate(sorted(r.sample(range(len(line)), edits), reverse=True)):
        out[at : at + 1] = [[f"new{seed}x{k}"], [], [out[at], f"new{seed}x{k}"]][k % 3]
    return out


def dropped(spark, rows: list[tuple[int | None, str]]) -> dict:
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.record.doc_id: r.n_dropped for r in line_dedup.without_repeated_lines(frame).collect()}


def test_all_lines_of_the_least_similarity_are_found(spark):
    rows = []
    for k, n in enumerate([4, 5, *range(10, 41)]):
        base = words(k, n)
        # the most edits that 0.8 allows, and one more
        longer = [*base, "more"] if n == 4 else edited(base, n // 5, 100 + k)
        rows += [(3 * k, " ".join(base)), (3 * k + 1, " ".join(longer))]
        rows.append((3 * k + 2, " ".join([f"far{k}x{i}" if i <= n // 5 + 1 else w for i, w in enumerate(base)])))
    found = dropped(spark, rows)
    assert [found[i] for i, _ in rows] == [0, 1, 0] * (len(rows) // 3)


def test_short_lines_and_lines_without_spaces(spark):
    chinese = "".join(chr(0x4E00 + 37 * k) for k in range(40))
    close = chinese[:20] + chr(0x9000) + chinese[21:]
    rows = [
        (1, "one\ntwo words\nreouha the of heble"),
        (2, "One!\nTwo, words.\nreouha the of heble\n--\n"),
        (3, "three words here\n--\n"),
        (4, chinese + "\nกขค"),
        (5, close),
        (6, "กขค"),
        (7, "".join(chr(0x4E01 + 41 * k) for k in range(40))),
    ]
    assert dropped(spark, rows) == {1: 0, 2: 3, 3: 0, 4: 0, 5: 1, 6: 1, 7: 0}


def test_repeated_rows_of_long_lines(spark):
    long, short = " ".join(words(50, 400)), " ".join(words(51, 30))
    rows = [(1, long)] * 3 + [(None, short)] * 60 + [(None, long)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r.record.doc_id, r.text, r.n_dropped) for r in line_dedup.without_repeated_lines(frame).collect()]
    # rows equal in id and text are one occurrence; the null id comes first
    assert sorted(found, key=str) == sorted([(1, "", 1)] * 3 + [(None, short, 0)] * 60 + [(None, long, 0)] * 2, key=str)


def within(a: list[str], b: list[str], may: int) -> bool:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= may


@pytest.mark.parametrize("block", [512, 7])
def test_all_links_of_a_hot_bucket(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    base, r = words(60, 40), random.Random(61)
    # all share a passage, and so buckets; members are close to some others only, seldom to the extremes
    lines = [base[:12] + [w if r.random() < 0.6 else f"v{r.randrange(4)}{i}" for i, w in enumerate(base[12:])] for _ in range(60)]
    lines += [edited(lines[k], 4, 200 + k) for k in range(0, 60, 2)]
    group = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if group[i] != group[j] and within(lines[i], lines[j], max(len(lines[i]), len(lines[j])) // 5):
                group = [group[j] if g == group[i] else g for g in group]
    wanted = {i: int(group[i] in group[:i]) for i in range(len(lines))}
    assert 20 < sum(wanted.values()) < 90
    assert dropped(spark, [(i, " ".join(x)) for i, x in enumerate(lines)]) == wanted
