"""Fuzzy line deduplication in DataFrame expressions: prefix filter on word pairs, edit similarity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packwatch.llm.blocks import in_blocks
from packwatch.llm.common import components, discard, settle, table
from packwatch.llm.quality import bind

SIMILARITY = 0.8
#: Shorter lines have no line of the least similarity but their equals.
LEAST_WORDS = 4
#: What stands between words of a lower-case line: ASCII signs and white space.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Characters of scripts that set no space between words: Thai, Lao, Myanmar, Khmer, Kana, Han.
UNSPACED = "[\\x{E00}-\\x{EFF}\\x{1000}-\\x{109F}\\x{1780}-\\x{17FF}\\x{3041}-\\x{30FF}\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{3FFFF}]"
#: Cells of the prefilters that say which texts are needed; bounds their broadcast.
CELLS = 1 << 20
BUCKET_CELLS = 1 << 22
#: Cells in which words are counted to take pairs of rare ones first, and the share of documents counted.
RANK_CELLS, RANK_SHARE = 1 << 18, 8
#: Bits of a word's hash in a bucket; ranks stand above them.
SHORT_BITS = 34
#: From so many words on a line has WIDE times 64 bits more, as 128 do not tell long lines apart.
LONG_WORDS, WIDE = 80, 8
#: Passes in which word pairs travel, each by its share of the buckets, so that a part of them lies on disk at once.
PASSES = 4
#: In buckets of so many lines at most each looks for another that may be close before it is stored.
FEW = 8
#: Lines of a bucket that are compared in one block.
BLOCK = 512
#: Spark's setting by which shuffle files go at the end of a query, and not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Words become one character each where lines are compared.
ALPHABET = 0xD000


def cell(key: Column, cells: int = CELLS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells)).cast("int")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """settle(); then the files of its shuffles go, as nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return settle(df, purpose)
    finally:
        conf.set(CLEANUP, before)


def numbered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows (doc, id, text): doc is a hash of id and text, which holds also for null or repeated ids."""
    text, row = F.col(f"`{text_column}`"), F.col(f"`{id_column}`")
    return docs.select(F.xxhash64(row, text).alias("doc"), row.alias("id"), text.alias("text"))


def spaced(text: Column) -> Column:
    """The text in lower case, with spaces around characters that are words of their own."""
    lower = F.lower(text)
    return F.when(F.octet_length(text) > F.length(text), F.regexp_replace(lower, UNSPACED, " $0 ")).otherwise(lower)


def cut(line: Column) -> Column:
    """Words of what spaced() gives."""
    return F.array_remove(F.split(line, BETWEEN), "")


def line_words(line: Column) -> Column:
    """Words in lower case; in scripts without spaces each character is one."""
    return cut(spaced(line))


def may_differ(longest: Column) -> Column:
    """The most edits of two lines of the least similarity."""
    return F.floor((1 - SIMILARITY) * longest + 1e-9).cast("int")


def may_lose(n: Column) -> Column:
    """The most word pairs of a line of n words that another line of the least similarity may lack.

    A word exchanged or left out takes two pairs from a line, one put in parts one. Against a line of at most n words
    that is 2 d with d = n / 5 edits. One of m > n words has m / 5 edits, m - n or more of them words put in, which take
    one pair less each: 2 (m / 5) - (m - n) is above 2 d only where n + 1 is a multiple of 5, by one.
    """
    return 2 * may_differ(n) + F.when(F.pmod(n + 1, F.lit(5)) == 0, 1).otherwise(0)


def rank_cells(rows: DataFrame) -> bytes:
    """For each cell of words, twice the logarithm of how many a share of the documents has, at most 63."""
    some = rows.where(F.pmod("doc", F.lit(RANK_SHARE)) == 0).select(F.explode(line_words(F.col("text"))).alias("word"))
    counts = some.groupBy(cell(F.col("word"), RANK_CELLS).alias("cell")).count().toArrow()
    ranks = np.zeros(RANK_CELLS, dtype=np.uint8)
    ranks[counts["cell"].to_numpy()] = np.minimum(63, (2 * np.log2(counts["count"].to_numpy())).astype(int) + 1)
    return ranks.tobytes()


def split_lines(rows: DataFrame, ranks: bytes) -> DataFrame:
    """Lines that have a word: the rows' other columns, pos, key, check, words, every, odd, wide, buckets.

    buckets are the word pairs by which a line is found. Lines share a pair
    among the first of each, one more than may be lost, in any fixed order of all word pairs, here those of rare words
    first; see may_lose(). Lines of fewer than LEAST_WORDS words have none. every and odd hold parities of the words
    that have a bit: every of all words, 64 bits, odd of half of them, so with those of the other half they are 128,
    and an edit changes two of these at most. wide has more such bits of long lines, WIDE times 64.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    half = SHORT_BITS // 2

    def ranked(h: Column) -> Column:
        at = h.bitwiseAND(F.lit(RANK_CELLS - 1)).cast("int") + 1
        rank = F.ascii(F.substring(F.lit(ranks), at, F.lit(1)).cast("string")).cast("long")
        return F.shiftleft(rank, SHORT_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - SHORT_BITS))

    def parity(hashes: Column, of) -> Column:
        # a shift goes by the last six bits
        return F.aggregate(hashes, zero, lambda a, h: a.bitwiseXOR(F.call_function("shiftleft", of(h), h)))

    def in_half(h: Column) -> Column:
        return F.shiftright(h, 6).bitwiseAND(F.lit(1)).cast("long")

    def line(text: Column, pos: Column) -> Column:
        def figures(words: Column) -> Column:
            n, plain = F.size(words), F.array_join(words, " ")
            inner = F.greatest(n - 1, F.lit(0))

            def pair(a: Column, b: Column) -> Column:
                # a word is its rank above a hash, so the sum has the rank of both; what is added tells their order
                return (a + b).bitwiseXOR(F.shiftrightunsigned(b, half).bitwiseAND(F.lit((1 << half) - 1)))

            def filed(marks: Column) -> Column:
                pairs = F.zip_with(F.slice(marks, 1, inner), F.slice(marks, 2, inner), pair)
                return F.array_distinct(F.slice(F.sort_array(pairs), 1, may_lose(n) + 1))

            def part(hashes: Column, k: int) -> Column:
                return parity(F.filter(hashes, lambda h: F.shiftright(h, 7).bitwiseAND(F.lit(WIDE - 1)) == k), lambda _: one)

            def of(hashes: Column) -> Column:
                wide = F.when(n >= LONG_WORDS, F.array(*[part(hashes, k) for k in range(WIDE)]))
                return F.struct(parity(hashes, lambda _: one).alias("every"), parity(hashes, in_half).alias("odd"), wide.alias("wide"))

            return F.struct(
                pos.alias("pos"),
                F.xxhash64(plain).alias("key"),
                F.hash(plain).alias("check"),
                n.alias("words"),
                bind(F.transform(words, lambda w: F.hash(w)), of).alias("bits"),
                F.when(n >= LEAST_WORDS, bind(F.transform(F.transform(words, lambda w: F.xxhash64(w)), ranked), filed)).alias("buckets"),
            )

        return bind(cut(text), figures)

    # one expression per text, so that nothing of it is computed twice
    lines = F.filter(F.transform(F.split(spaced(F.col("text")), "\n"), line), lambda x: x["words"] > 0)
    lines = rows.select(*[c for c in rows.columns if c != "text"], F.inline(lines))
    return lines.select("*", "bits.*").drop("bits")


def prefixes(rows: DataFrame, ranks: bytes) -> DataFrame:
    """Rows (key, n, bucket): the lines of texts, each with the word pairs it is filed under."""
    return split_lines(rows, ranks).select("key", F.col("words").alias("n"), F.explode("buckets").alias("bucket"))


def bucketed(found: DataFrame) -> DataFrame:
    """Rows (bucket, key, low, high), stored: the lines in buckets that lines share, with the bucket's least and largest key.

    Each line travels once, in one of PASSES by its bucket, as its key, length and parity bits. In buckets of FEW lines only
    those stay that by length and bits may be close to another, and the least and largest key are theirs; larger
    buckets stay whole.
    """
    filed = found.select("key", "words", "every", F.explode("buckets").alias("bucket"))
    own = Window.partitionBy("bucket")

    def with_ends(rows: DataFrame) -> DataFrame:
        return rows.select("*", F.min("key").over(own).alias("low"), F.max("key").over(own).alias("high"))

    def close(mate: Column) -> Column:
        may = may_differ(F.greatest(mate["words"], "words"))
        near = (F.abs(mate["words"] - F.col("words")) <= may) & (F.bit_count(mate["every"].bitwiseXOR(F.col("every"))) <= 2 * may)
        return (mate["key"] != F.col("key")) & near

    near = None
    for k in range(PASSES):
        here = with_ends(filed.where(F.pmod("bucket", F.lit(PASSES)) == k)).where("low < high")
        here = here.groupBy("bucket", "key").agg(F.min("words").alias("words"), F.min("every").alias("every"))
        here = here.withColumn("n", F.count("*").over(own))
        mate = F.when(F.col("n") <= FEW, F.struct("key", "words", "every"))
        here = here.withColumn("mates", F.collect_list(mate).over(own))
        here = here.where((F.col("n") > FEW) | F.exists("mates", close)).select("bucket", "key")
        here = stored(with_ends(here), "line-near")
        near = here if near is None else near.unionByName(here)
    return near


def _may_be_close(a: str, b: str) -> Column:
    """What holds for the lengths and parity bits of all lines of the least similarity."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    may = may_differ(F.greatest(x("words"), y("words")))
    every, odd = x("every").bitwiseXOR(y("every")), x("odd").bitwiseXOR(y("odd"))
    bits = F.bit_count(odd) + F.bit_count(every.bitwiseXOR(odd))
    near = (F.abs(x("words") - y("words")) <= may) & (bits <= 2 * may)
    more = [F.bit_count(F.get(x("wide"), F.lit(k)).bitwiseXOR(F.get(y("wide"), F.lit(k)))) for k in range(WIDE)]
    # null for lines that are not both long
    return near & F.coalesce(sum(more[1:], more[0]) <= 2 * may, F.lit(True))


def centre_pairs(near: DataFrame, distinct: DataFrame) -> DataFrame:
    """Pairs (u, v) of line keys: each member of a bucket with its least and largest key.

    They link most members of a group of near copies; rest_pairs() finds what they leave.
    """
    pairs = (
        near.select("key", F.explode(F.array("low", "high")).alias("centre"))
        .where("key <> centre")
        .select(F.least("key", "centre").alias("u"), F.greatest("key", "centre").alias("v"))
        .distinct()
    )
    line = F.struct("words", "every", "odd", "wide")
    first = distinct.select(F.col("key").alias("u"), line.alias("a"))
    second = distinct.select(F.col("key").alias("v"), line.alias("b"))
    return pairs.join(first, "u").join(second, "v").where(_may_be_close("a", "b")).select("u", "v")


def rest_pairs(near: DataFrame, groups: DataFrame, distinct: DataFrame) -> DataFrame:
    """All other pairs (u, v) of a bucket's line keys that may be close and are not in one group yet.

    The least and largest key were compared with all, so the members between them are left. Buckets of one group are
    left out; others are dealt into pairs of parts, and the tests stand in the join, so that pairs of a group make no rows.
    The result is stored, and what led to it deleted.
    """
    between = near.where("key <> low AND key <> high").select("bucket", "key")
    grouped = between.join(groups, "key", "left").withColumn("component", F.coalesce("component", "key"))
    own = Window.partitionBy("bucket")
    mixed = grouped.select(
        F.lit(0).alias("t"),
        "bucket",
        "key",
        "component",
        F.min("component").over(own).alias("low"),
        F.max("component").over(own).alias("high"),
        F.count("*").over(own).alias("n"),
    )
    mixed = stored(mixed.where("low < high").drop("low", "high"), "line-mixed")
    line = F.struct("words", "every", "odd", "wide", "component")
    rows = mixed.join(distinct, "key").select("t", "bucket", F.col("key").alias("id"), line.alias("line"))
    dealt = stored(in_blocks(rows, mixed.select("t", "bucket", "n").distinct(), BLOCK, "inner"), "line-dealt")
    at = ["bucket", "low", "high"]
    first = dealt.where("part = low").select(*at, F.col("id").alias("u"), F.col("line").alias("a"))
    second = dealt.where("part = high").select(*at, F.col("id").alias("v"), F.col("line").alias("b"))
    apart = (F.col("a.component") != F.col("b.component")) & ((F.col("low") < F.col("high")) | (F.col("u") < F.col("v")))
    pairs = (
        first.join(second, at)
        .where(apart & _may_be_close("a", "b"))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )
    pairs = stored(pairs, "line-pairs")
    discard(mixed, dealt)
    return pairs


def coded(words: Column) -> Column:
    """A string with one character per word, equal for equal words."""
    digit = lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(ALPHABET)) + 256), 4, "0")
    return F.decode(F.unhex(F.array_join(F.transform(words, digit), "")), "UTF-16BE")


def verified(pairs: DataFrame, distinct: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose lines have an edit similarity of SIMILARITY or more, in words, stored; what led to it is deleted."""
    keys = pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct()
    wanted = stored(distinct.join(keys, "key").select("key", "first.doc", "first.pos"), "line-wanted")
    # texts stay where they are: only lines whose cell has a wanted one travel
    spot = cell(F.struct("doc", "pos"), BUCKET_CELLS)
    cells = F.broadcast(wanted.select(cell(F.col("doc")).alias("cell")).distinct())
    spots = F.broadcast(wanted.select(spot.alias("spot")).distinct())
    texts = rows.withColumn("cell", cell(F.col("doc"))).join(cells, "cell", "left_semi")
    lines = texts.select("doc", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("spot", spot)
    lines = lines.join(spots, "spot", "left_semi").select("doc", "pos", "line").dropDuplicates(["doc", "pos"])
    codes = lines.join(wanted, ["doc", "pos"]).select("key", coded(line_words(F.col("line"))).alias("code"))
    codes = stored(codes, "line-codes")
    both = pairs.join(codes.select(F.col("key").alias("u"), F.col("code").alias("a")), "u").join(
        codes.select(F.col("key").alias("v"), F.col("code").alias("b")), "v"
    )
    longest = F.greatest(F.length("a"), F.length("b"))
    may = may_differ(longest)
    close = F.abs(F.length("a") - F.length("b")) <= may
    # the threshold of levenshtein() is a constant, so the band is that of a class of lengths
    distance = F.lit(-1)
    for power in range(4, 31):
        band = int((1 - SIMILARITY) * (1 << power) + 1e-9)
        here = (longest <= (1 << power)) & (longest > (1 << (power - 1) if power > 4 else 0))
        distance = F.when(here, F.levenshtein("a", "b", band)).otherwise(distance)
    links = both.where(close).withColumn("d", distance).where((F.col("d") >= 0) & (F.col("d") <= may)).select("u", "v")
    links = stored(links, "line-links")
    discard(wanted, codes)
    return links


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc, places), stored: the lines, counted from 0, that repeat an earlier one's group.

    Lines are compared by their words in lower case, without ASCII signs; those without a word
    are never dropped. Equal lines of any length, and all lines linked by
    edit similarity, make connected groups; of each the occurrence with the least
    (id, position) stays. Keys of 64 bits that stand for different lines are
    told by a second hash, and such lines stay. Rows equal in id and text count as one row.
    Every other table stored on the way is deleted as soon as nothing reads it.
    """
    rows = numbered(docs, id_column, text_column).where(F.col("text").isNotNull())
    found = stored(split_lines(rows, rank_cells(rows)), "line-found")
    distinct = stored(
        found.groupBy("key")
        .agg(
            F.min(F.struct("id", "doc", "pos")).alias("first"),
            F.count("*").alias("n"),
            F.min("check").alias("least"),
            F.max("check").alias("most"),
            *[F.min(c).alias(c) for c in ("words", "every", "odd", "wide")],
        )
        .where("least = most")
        .drop("least", "most"),
        "line-distinct",
    )
    near = bucketed(found)
    pairs = stored(centre_pairs(near, distinct), "line-pairs")
    links = verified(pairs, distinct, rows)
    groups = components(links, "line").select(F.col("id").alias("key"), "component")
    discard(pairs, links)
    pairs = rest_pairs(near, groups, distinct)
    discard(near)
    links = verified(pairs, distinct, rows)
    first = groups
    groups = components(first.select(F.col("key").alias("u"), F.col("component").alias("v")).unionByName(links), "line")
    groups = groups.select(F.col("id").alias("key"), "component")
    discard(pairs, links, first)
    # a line matters if it has a copy or a group
    linked = distinct.join(groups, "key", "left").where((F.col("n") > 1) | F.col("component").isNotNull())
    linked = linked.withColumn("component", F.coalesce("component", "key"))
    heads = linked.groupBy("component").agg(F.min("first").alias("head"))
    heads = stored(linked.select("key", "component").join(heads, "component").select("key", "head"), "line-heads")
    discard(distinct, groups)
    again = found.select("key", "doc", "pos").join(heads, "key").where(~((F.col("doc") == F.col("head.doc")) & (F.col("pos") == F.col("head.pos"))))
    dropped = stored(again.groupBy("doc").agg(F.collect_set("pos").alias("places")), "line-dropped")
    discard(found, heads)
    return dropped


def without_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (record, text, n_lines, n_dropped): the input's columns and the text that is left.

    A null text stays null with no lines; an empty one has one line, which stays. A
    document may lose all lines and stays with an empty text. Columns may have any name; an empty
    table gives no rows. Texts meet their dropped lines in one shuffle, and only those texts
    whose cell has dropped lines.
    """
    dropped = repeated_lines(docs, id_column, text_column)
    text = F.col(f"`{text_column}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("record"),
        text.alias("text"),
        F.xxhash64(F.col(f"`{id_column}`"), text).alias("doc"),
    ).withColumn("cell", cell(F.col("doc")))
    cells = F.broadcast(dropped.select(cell(F.col("doc")).alias("cell")).distinct())
    lines = F.split("text", "\n")
    count = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    count = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(count)
    same = rows.join(cells, "cell", "left_anti").select("record", "text", count.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("places", i)), "\n")
    changed = (
        rows.join(cells, "cell", "left_semi")
        .join(dropped, "doc", "left")
        .select(
            "record",
            F.when(F.col("places").isNull(), F.col("text")).otherwise(left).alias("text"),
            count.alias("n_lines"),
            F.coalesce(F.array_size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
    return same.unionByName(changed)


def line_deduplicated(docs: DataFrame) -> DataFrame:
    """Documents without repeated lines; same columns, n_chars counted anew."""
    found = without_repeated_lines(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[(new[c] if c in new else F.col(f"record.`{c}`")).alias(c) for c in docs.columns])


def deduplicated_documents(spark, folder: str) -> DataFrame:
    """op6: lines, dropped lines and digest of the text left, of every document."""
    found = without_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("record.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))
