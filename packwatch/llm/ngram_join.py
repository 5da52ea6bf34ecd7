"""Jaccard join on word n-grams: MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packwatch.llm.blocks import each_block, in_blocks, pair_mask, summed_links
from packwatch.llm.common import WHITE, components, settle, table

WORDS = 5
THRESHOLD = 0.8
#: 16 bands of 5 hashes bring together 99.8 % of the pairs of similarity 0.8.
BANDS, ROWS = 16, 5
#: Hashes compared before each look at the posterior.
STEP = 16
#: A pair is dropped when similarity >= the threshold is less probable than this.
TOLERANCE = 1e-4
BLOCK = 256
SEED = 5
#: Cells of the prefilter that says which documents may be candidates; bounds its broadcast.
CELLS = 1 << 20
REMEMBERED = 300_000


class WordHashes(dict):
    """64-bit hashes of words, remembered within a worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        self[word] = value
        return value


def shingles(words: list[str], n: int = WORDS) -> list[tuple]:
    """The n-grams of a text; one shorter than n words is a single gram, none if empty."""
    if not words:
        return []
    if len(words) < n:
        return [tuple(words)]
    return list(zip(*(words[i:] for i in range(n)), strict=False))


def _coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (
        rng.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
        rng.integers(0, 2**63, count, dtype=np.uint64),
    )


def minhashes(words: list[str], a: np.ndarray, b: np.ndarray, known: WordHashes) -> np.ndarray:
    """Upper 32 bits of the least of each hash function over the n-grams of a text."""
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(words))
    grams = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for i in range(n):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(grams)]
    grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(29)
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 1024):
        least = np.minimum(least, (grams[at : at + 1024, None] * a + b).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def least_matches(hashes: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For 0..hashes compared: the fewest matches with which a pair stays.

    With a uniform prior the similarity after m matches of n has a Beta(m + 1, n - m + 1)
    posterior, whose mass above the threshold is a binomial sum.
    """
    out = []
    for n in range(hashes + 1):
        m, mass = -1, 0.0
        while mass < tolerance and m < n:
            m += 1
            # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
            mass = sum(math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))
        out.append(m)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """Rows (id, text_hash, bands, signature) of the texts that have a word."""
    kind = docs.schema["id"].dataType.simpleString()

    def sign(batches):
        a, b = _coefficients(BANDS * ROWS)
        known = sys.__dict__.setdefault("_llm_words", WordHashes())
        mix = np.random.default_rng(SEED + 1).integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            keys, bands, signs = [], [], []
            for text in batch.column("text").to_pylist():
                least = minhashes(words_of(text), a, b, known)
                signs.append(least.tobytes())
                bands.append((least.reshape(BANDS, ROWS).astype(np.uint64) * mix).sum(axis=1, dtype=np.uint64).view(np.int64))
                keys.append(hashlib.md5(text.encode("utf-8", "surrogatepass")).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                ["id", "text_hash", "bands", "signature"],
            )

    worded = docs.where(F.col("id").isNotNull() & F.col("text").rlike(f"[^{WHITE}]"))
    return worded.mapInArrow(sign, f"id {kind}, text_hash binary, bands array<long>, signature binary")


def words_of(text: str) -> list[str]:
    """Words between ASCII white space."""
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def compare(block: pa.Table):
    """Links among the members of a block: pruned by hashes first, then counted exactly."""
    ids, copies, part = (block[c].to_numpy() for c in ("id", "copies", "part"))
    t, low, high = (block[c][0].as_py() for c in ("t", "low", "high"))
    signs = np.stack([np.frombuffer(s, dtype=np.uint32) for s in block["signature"].to_pylist()])
    bands = np.array(block["bands"].to_pylist(), dtype=np.int64)
    first, second = np.nonzero(pair_mask(low, high, part))
    keep = least_matches(signs.shape[1])
    matches = np.zeros(len(first), dtype=np.int64)
    for at in range(0, signs.shape[1], STEP):
        matches += (signs[first, at : at + STEP] == signs[second, at : at + STEP]).sum(axis=1)
        stay = matches >= keep[min(at + STEP, signs.shape[1])]
        first, second, matches = first[stay], second[stay], matches[stay]
    if not len(first):
        return
    number: dict[tuple, int] = {}
    texts = block["text"]
    grams = {
        i: frozenset([number.setdefault(g, len(number)) for g in shingles(words_of(texts[i].as_py()))])
        for i in np.unique(np.concatenate([first, second])).tolist()
    }

    def linked(i: int, j: int) -> bool:
        x, y = grams[i], grams[j]
        if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)):
            return False
        both = len(x & y)
        return both >= THRESHOLD * (len(x) + len(y) - both) - 1e-9

    sure = np.array([linked(i, j) for i, j in zip(first.tolist(), second.tolist(), strict=True)], dtype=bool)
    first, second = first[sure], second[sure]
    counted = ~(bands[first, :t] == bands[second, :t]).any(axis=1)
    yield from summed_links(ids, np.zeros(len(ids), dtype=np.int64), copies, first, second, counted)


def near_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, class_id, n_links) of every document; links have 5-gram Jaccard >= 0.8.

    Words stand between ASCII white space, as they are. A text of fewer than five words is one
    gram; null and empty texts, and rows with a null id, link with nothing. Equal texts make a
    class, found with map-side combining, and are links of one another; class_id is
    the smallest id reachable by links. An id that repeats is one node of the links, with a row for
    each of its rows. An empty table gives no rows; other columns play no part.

    Classes meet in bands of MinHash values. Buckets with the same members are worked on once,
    in pairs of blocks of bounded size; a pair is counted in the first band that it shares and
    never becomes a row. Texts travel only for classes that share a bucket.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    signed = settle(signatures(rows), "text-signatures")
    classes = settle(
        signed.groupBy("text_hash").agg(
            F.min("id").alias("id"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
        ),
        "text-classes",
    )
    banded = classes.select("id", F.posexplode("bands").alias("t", "bucket"))
    members = F.xxhash64("id")
    buckets = (
        banded.groupBy("t", "bucket")
        .agg(F.count("*").alias("n"), F.bit_xor(members).alias("x"), F.bit_xor(F.xxhash64(members)).alias("y"))
        .where("n > 1")
    )
    # of buckets with the same members the first band's: the one that counts their pairs
    buckets = settle(
        buckets.groupBy("n", "x", "y").agg(F.min(F.struct("t", "bucket")).alias("b")).select("b.t", "b.bucket", "n"),
        "text-buckets",
    )
    shared = settle(in_blocks(banded, buckets, BLOCK, "inner"), "text-shared")
    cell = F.pmod(F.xxhash64("id"), F.lit(CELLS))
    cells = F.broadcast(shared.select(cell.alias("cell")).distinct())
    wanted = shared.select("id").distinct()
    # one text for each class: of the rows of its smallest id, those with its own hash
    texts = (
        rows.withColumn("cell", cell)
        .join(cells, "cell", "left_semi")
        .drop("cell")
        .join(wanted, "id", "left_semi")
        .withColumn("text_hash", F.unhex(F.md5("text")))
        .withColumn("one", F.row_number().over(Window.partitionBy("id", "text_hash").orderBy(F.lit(0))))
        .where("one = 1")
        .drop("one")
        .join(classes, ["id", "text_hash"])
        .drop("text_hash")
    )
    found = settle(each_block(shared.join(texts, "id"), compare), "text-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("u"), F.col("other").alias("v")), "text")
    result = (
        classes.select("text_hash", "id", "copies")
        .join(links, "id", "left")
        .join(groups, "id", "left")
        .select(
            "text_hash",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("class_id"),
        )
    )
    alone = rows.where(~(F.col("id").isNotNull() & F.col("text").rlike(f"[^{WHITE}]")) | F.col("id").isNull() | F.col("text").isNull())
    return (
        signed.select("id", "text_hash")
        .join(result, "text_hash")
        .select("id", "class_id", "n_links")
        .unionByName(alone.select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    )


def joined_documents(spark, folder: str) -> DataFrame:
    """op7: class, links and verdict of every document."""
    found = near_texts(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Documents without those that are near copies of one with a smaller id; same columns.

    Rows that share an id and a text are copies too: one stays. Rows without an id or a word stay.
    """
    found = near_texts(docs)
    dropped = found.where("id <> class_id").select(F.col("id").alias("doc_id")).distinct()
    left = docs.join(settle(dropped, "text-dropped"), "doc_id", "left_anti")
    worded = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(f"[^{WHITE}]"), F.lit(False))
    repeated = settle(found.groupBy("id").count().where("count > 1 AND id IS NOT NULL").select(F.col("id").alias("doc_id")), "text-repeated")
    # only ids that occur more than once need their rows compared
    several = left.join(repeated, "doc_id", "left_semi").where(worded)
    nth = F.row_number().over(Window.partitionBy("row.doc_id", "row.text").orderBy(F.lit(0)))
    several = several.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("nth", nth)
    return (
        left.join(repeated, "doc_id", "left_anti")
        .unionByName(left.join(repeated, "doc_id", "left_semi").where(~worded))
        .unionByName(several.where("nth = 1").select("row.*"))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
