"""Each line travels once to where its word pairs meet, and what has been compared is not compared again."""

import glob
import os
import random

import pytest

pytest.importorskip("packwatch.llm")

from pyspark.sql import functions as F  # noqa: E402

from packwatch.llm import line_dedup  # noqa: E402


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklm") for _ in range(7)) for _ in range(n)]


def found(spark, texts: list[str]):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").withColumn("id", F.col("doc"))
    return line_dedup.split_lines(rows, bytes(line_dedup.RANK_CELLS))


def test_only_shared_buckets_go_on(spark):
    base = words(1, 30)
    close = [*base[:20], "other", *base[21:]]
    texts = [" ".join(words(k, 30)) for k in range(2, 60)] + [" ".join(base) + "\n" + " ".join(base), " ".join(close)]
    lines = found(spark, texts)
    keys = {r.key for r in lines.where("doc >= 58").collect()}
    near = line_dedup.bucketed(lines).collect()
    assert len(keys) == 2 and {r.key for r in near} == keys
    assert {(r.low, r.high) for r in near} == {(min(keys), max(keys))}
    # an occurrence more of a line adds no row
    assert len(near) == len({(r.bucket, r.key) for r in near}) == 2 * len({r.bucket for r in near})


def test_the_order_of_two_words_tells_pairs(spark):
    a, b = words(70, 2)
    filed = [len(r.buckets) for r in found(spark, [f"{a} {b} {a} {b}", f"{b} {a} {b} {a}"]).collect()]
    # two of three pairs count, of which two are equal
    assert sorted(filed) == [1, 2]


def test_members_compared_with_the_extremes_are_left_out(spark):
    lines = found(spark, [" ".join(words(80 + k, 10)) for k in range(5)])
    distinct = lines.select("key", "words", F.lit(0).cast("long").alias("every"), F.lit(0).cast("long").alias("odd"), "wide")
    keys = sorted(r.key for r in distinct.collect())
    none = spark.createDataFrame([], "key long, component long")

    def rest(members: list[int]) -> set:
        near = spark.createDataFrame([(7, k, members[0], members[-1]) for k in members], "bucket long, key long, low long, high long")
        return {(r.u, r.v) for r in line_dedup.rest_pairs(near, none, distinct).collect()}

    assert rest(keys[:2]) == rest(keys[:3]) == set()
    assert rest(keys) == {(keys[1], keys[2]), (keys[1], keys[3]), (keys[2], keys[3])}


def test_long_lines_are_told_apart_before_they_travel(spark):
    base = words(90, 200)
    texts = [" ".join(base), " ".join([*base[:40], *words(91, 40), *base[80:]]), " ".join([*base[:20], *words(92, 180)])]
    lines = found(spark, texts)
    keys = [r.key for r in lines.orderBy("doc").collect()]
    near = line_dedup.bucketed(lines)
    # 40 edits of 200 may be close, 180 may not, though all share word pairs
    assert {r.key for r in near.collect()} == set(keys)
    assert {frozenset((r.u, r.v)) for r in line_dedup.centre_pairs(near, lines).collect()} == {frozenset(keys[:2])}


def test_shuffle_files_go_with_the_query(spark, tmp_path):
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folder for f in glob.glob(os.path.join(d, "*", "shuffle_*.data"))}
    before, setting = files(), spark.conf.get(line_dedup.CLEANUP, None)
    counts = line_dedup.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-stored")
    assert counts.count() == 7
    assert spark.conf.get(line_dedup.CLEANUP, None) == setting
    left = files() - before
    # that of the count above alone may be left
    assert all(os.path.getsize(f) < 2000 for f in left) and len(left) <= 4
