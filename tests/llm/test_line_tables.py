"""What line dedup stores on its way: few rows, and none for longer than they are read."""

import os
import random

import pytest

pytest.importorskip("packwatch.llm")

from pyspark.sql import functions as F  # noqa: E402

from packwatch.llm import common, line_dedup  # noqa: E402


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklm") for _ in range(7)) for _ in range(n)]


def found(spark, lines: list[list[str]]):
    rows = spark.createDataFrame(list(enumerate(map(" ".join, lines))), "doc long, text string").withColumn("id", F.col("doc"))
    return line_dedup.split_lines(rows, bytes(line_dedup.RANK_CELLS))


def test_lines_without_a_close_one_are_not_stored(spark):
    passage = words(1, 8)
    # all share a passage; of a few such lines only those close to another stay, with their own least and largest key
    far = [[*passage, *words(10 + k, 12)] for k in range(4)]
    longer = [*passage, *words(30, 40)]
    close = [*far[0][:15], "other", *far[0][16:]]
    lines = found(spark, [*far, longer, close])
    keys = {r.doc: r.key for r in lines.collect()}
    near = line_dedup.bucketed(lines).collect()
    pair = {keys[0], keys[5]}
    assert near and {r.key for r in near} == pair and {(r.low, r.high) for r in near} == {(min(pair), max(pair))}
    assert line_dedup.bucketed(found(spark, [*far[1:], longer])).count() == 0


def test_large_buckets_stay_whole(spark):
    passage = words(2, 8)
    lines = found(spark, [[*passage, *words(50 + k, 12)] for k in range(line_dedup.FEW + 1)])
    near = line_dedup.bucketed(lines).collect()
    assert {r.key for r in near} == {r.key for r in lines.collect()}


@pytest.fixture
def folders(tmp_path, monkeypatch):
    real = common.work_folder
    monkeypatch.setattr(common, "work_folder", lambda spark, purpose: str(tmp_path / os.path.basename(real(spark, purpose))))
    return lambda: sorted(name[:-33] for name in os.listdir(tmp_path))


def test_tables_go_when_nothing_reads_them(spark, folders):
    base = words(3, 30)
    texts = [" ".join(base), " ".join([*base[:7], "new", *base[8:]]), " ".join(base), " ".join(words(4, 30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = line_dedup.without_repeated_lines(docs)
    # groups of lines need none of the tables before them
    assert folders() == ["line-dropped"]
    assert {r.record.doc_id: r.n_dropped for r in left.collect()} == {0: 0, 1: 1, 2: 1, 3: 0}


def test_only_own_tables_are_deleted(spark, folders, tmp_path):
    other = str(tmp_path / "documents.parquet-00000000000000000000000000000000-x")
    spark.range(5).write.parquet(other)
    mine, read = common.settle(spark.range(3), "some"), spark.read.parquet(other)
    common.discard(read, mine.unionByName(read))
    assert read.count() == 5 and os.listdir(tmp_path) == [os.path.basename(other)]
