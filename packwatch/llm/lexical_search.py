"""Ranked lexical search, reversed: documents stream through an inverted index of the items' terms."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packwatch.llm.common import settle, table

#: Documents returned for each item.
BEST = 10
#: Postings (item, term) of one index; more items are taken in blocks, each with an index of its own.
BLOCK_POSTINGS = 500_000
#: Cells (document, item) that are scored at once.
STEP_CELLS = 1 << 18
#: Groups in which an item's rows are merged before they meet in one.
MERGE = 64
#: Terms of an item up to which sums of doubles are exact: a term adds less than 4.5e10.
EXACT_TERMS = 200_000

#: Bytes of a text: A-Z in lower case, other ASCII signs as spaces, the rest as it is.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: str) -> list[bytes]:
    """All terms of a whole text, repeats included."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def item_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Distinct rows (id, term); rows of equal id are one item with all their terms."""
    rows = items.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).where("text IS NOT NULL")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.binary()))], ["id", "terms"])

    found = rows.mapInArrow(run, f"id {kind}, terms array<binary>")
    return found.select("id", F.explode("terms").alias("term")).distinct()


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """Rows (id, n, terms, counts): terms in a document, and which of the vocabulary occur how often.

    Documents without a term are left out.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).where("text IS NOT NULL")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, sizes, found, counts = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = terms(text)
                if not words:
                    continue
                tally: dict[int, int] = {}
                for at in map(vocabulary.get, words):
                    if at is not None:
                        tally[at] = tally.get(at, 0) + 1
                ids.append(i)
                sizes.append(len(words))
                found.append(list(tally))
                counts.append(list(tally.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(ids, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["id", "n", "terms", "counts"],
            )

    return rows.mapInArrow(run, f"id {kind}, n long, terms array<int>, counts array<long>")


def weight(n_docs: int, holding: int) -> int:
    """Weight of a term that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def length_norms(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with so many terms."""
    if 90 * int(sizes.max(initial=0)) * n_docs < 1 << 63:
        return 10 + (90 * sizes * n_docs) // n_terms
    return np.array([10 + (90 * n * n_docs) // n_terms for n in sizes.tolist()], dtype=np.int64)


def order(row: tuple) -> tuple:
    """Highest score first, then the least id, null ids last."""
    score, ident = row
    return (-score, ident is None, 0 if ident is None else ident)


def best_of_tasks(
    found: DataFrame, items: list, kind: str, postings: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, best: int
) -> DataFrame:
    """Rows (item_id, doc_id, score): each task's best documents of each item.

    A task keeps one list per item, cut back to the best whenever it has grown to four times that.
    """
    sizes = np.array([len(p) for p in postings], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    holders = np.array([i for p in postings for i in p], dtype=np.int64)
    most = int(np.bincount(holders).max()) if len(holders) else 0
    step = max(1, STEP_CELLS // max(len(items), 1))
    id_kind = found.schema["id"].dataType.simpleString()

    def scores(entries_doc, entries_term, value, docs) -> np.ndarray:
        """Sums over the postings of each entry: docs x items, exact."""
        times = sizes[entries_term]
        ends = np.cumsum(times)
        within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - times, times)
        cell = np.repeat(entries_doc, times) * len(items) + holders[np.repeat(starts[entries_term], times) + within]
        value, cells = np.repeat(value, times), docs * len(items)
        if most <= EXACT_TERMS:
            total = np.bincount(cell, value, cells).astype(np.int64)
        else:
            total = np.bincount(cell, value >> 20, cells).astype(np.int64) << 20
            total += np.bincount(cell, value & ((1 << 20) - 1), cells).astype(np.int64)
        return total.reshape(docs, len(items))

    def run(batches):
        heaps: list[list[tuple]] = [[] for _ in items]
        least = np.ones(len(items), dtype=np.int64)
        out_kind = None

        def cut(i: int) -> None:
            heaps[i] = heapq.nsmallest(best, heaps[i], key=order)
            if len(heaps[i]) == best:
                least[i] = max(heaps[i][-1][0], 1)

        for batch in batches:
            ids, listed, counted = batch.column("id"), batch.column("terms"), batch.column("counts")
            out_kind = ids.type
            norms = length_norms(batch.column("n").to_numpy(), n_docs, n_terms)
            offsets = listed.offsets.to_numpy().astype(np.int64)
            offsets = offsets - offsets[0]
            term, tf = listed.flatten().to_numpy(), counted.flatten().to_numpy()
            doc = np.repeat(np.arange(len(norms)), np.diff(offsets))
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norms[doc]))
            for a in range(0, len(norms), step):
                b = min(a + step, len(norms))
                part = slice(offsets[a], offsets[b])
                total = scores(doc[part] - a, term[part], value[part], b - a)
                for at, i in zip(*(x.tolist() for x in np.nonzero(total >= least)), strict=True):
                    if total[at, i] >= least[i]:
                        heaps[i].append((int(total[at, i]), ids[a + at].as_py()))
                        if len(heaps[i]) >= 4 * best:
                            cut(i)
        if out_kind is None:
            return
        for i in range(len(items)):
            cut(i)
        rows = [(i, ident, score) for i, heap in enumerate(heaps) for score, ident in heap]
        item = pa.array([r[0] for r in rows], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [item, pa.array([r[1] for r in rows], out_kind), pa.array([r[2] for r in rows], pa.int64())],
            ["item", "doc_id", "score"],
        )

    kept = found.mapInArrow(run, f"item int, doc_id {id_kind}, score long")
    # the block's items are a literal array: their number is bounded by its postings
    names = found.sparkSession.createDataFrame(list(enumerate(items)), f"item int, item_id {kind}")
    return kept.join(F.broadcast(names), "item").drop("item")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    doc_columns: tuple[str, str] = ("doc_id", "text"),
    item_columns: tuple[str, str] = ("item_id", "text"),
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``best`` documents of each item.

    Items are indexed in blocks of about ``block_postings`` distinct (item, term) by a hash of their id; every
    block's index is broadcast and the terms of all documents are counted against it, whole texts, once. The
    counts that the index can use are stored; from them come the statistics of the corpus and the scores.
    A task holds an index and a bounded list per item; the lists of all tasks are merged in two steps.

    Null and empty texts have no terms and neither count nor rank. Item rows of equal id are one item with
    the terms of all of them; an item without terms has no rows. Documents that repeat, also by id, are ranked each;
    equal scores go by ascending doc_id, null last, and equal rows are interchangeable. Empty tables give
    no rows; other columns may have any name.
    """
    spark = docs.sparkSession
    wanted = settle(item_terms(items, *item_columns), "search-items")
    kind = wanted.schema["id"].dataType.simpleString()
    doc_kind = docs.schema[doc_columns[0]].dataType.simpleString()
    blocks = max(1, math.ceil(wanted.count() / block_postings))
    found = spark.createDataFrame([], f"item_id {kind}, doc_id {doc_kind}, score long")
    for block in range(blocks):
        here = wanted.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        if not here:
            continue
        items_here = sorted({r["id"] for r in here}, key=lambda x: (x is None, 0 if x is None else x))
        number = {x: i for i, x in enumerate(items_here)}
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in here}))}
        postings: list[list[int]] = [[] for _ in vocabulary]
        for r in here:
            postings[vocabulary[bytes(r["term"])]].append(number[r["id"]])
        counted = settle(term_counts(docs, vocabulary, *doc_columns), "search-terms")
        state = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not state["docs"]:
            return found.select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
        holding = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = np.array([weight(state["docs"], holding.get(i, 0)) for i in range(len(vocabulary))], dtype=np.int64)
        found = found.unionByName(
            best_of_tasks(counted, items_here, kind, postings, weights, state["docs"], state["terms"], best)
        )
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item_id", "_part").orderBy(*by)
    merged = (
        found.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(MERGE)))
        .withColumn("rank", F.row_number().over(some))
        .where(F.col("rank") <= best)
    )
    return (
        merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*by)))
        .where(F.col("rank") <= best)
        .select("item_id", "rank", "doc_id", "score")
    )


def ranked_documents(spark, folder: str) -> DataFrame:
    """op12: the ten best documents of every benchmark item."""
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = (
    f"regexp_extract_all(translate(text, '{_LETTERS}', '{_LETTERS.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
RANKED_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
whole AS (SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM docs WHERE len(terms) > 0),
counts AS (
  SELECT r, doc_id, term, len AS size, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms) AS len, unnest(terms) AS term FROM docs) GROUP BY ALL),
item_terms AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, whole GROUP BY term, n),
scores AS (
  SELECT item_id, r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // l)))) AS BIGINT) AS score
  FROM item_terms JOIN counts USING (term) JOIN weights USING (term), whole GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= {BEST}
"""
