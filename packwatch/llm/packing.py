"""Packing of documents into sequences: shortest pack first over the histogram of lengths."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packwatch.llm.bpe import map_text
from packwatch.llm.common import settle, table

SEQUENCE = 2048
#: The id after each document.
END_ID = 1
#: Pieces of one length that are numbered together on average, were all of one length.
RANKED_TOGETHER = 100_000


def pack_histogram(histogram: dict[int, int], most: int) -> list[tuple[int, list[int]]]:
    """Packing patterns (count, lengths) that place every length of a histogram once.

    Lengths go longest first. Each joins the shortest pack with room for it, as many
    copies at a time as there are of both; what is left opens packs of its own. At most
    ``most`` lengths and so a bounded number of patterns, whatever the counts.
    """
    done: list[tuple[int, list[int]]] = []
    room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)

    def put(count: int, pattern: list[int], left: int) -> None:
        if left:
            room[left].append((count, pattern))
        else:
            done.append((count, pattern))

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        for left in sorted((r for r in room if r >= length), reverse=True):
            while todo and room[left]:
                count, pattern = room[left].pop()
                used = min(count, todo)
                if count > used:
                    room[left].append((count - used, pattern))
                put(used, [*pattern, length], left - length)
                todo -= used
            if not room[left]:
                del room[left]
            if not todo:
                break
        if todo:
            put(todo, [length], most - length)
    return done + [p for packs in room.values() for p in packs]


def placements(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): a piece of a length and rank from
    there on lies in the sequence as many further on, at that offset."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def token_pieces(docs: DataFrame, vocabulary: str, most: int = SEQUENCE) -> DataFrame:
    """Pieces of at most ``most`` ids of every document of (doc_id, text), the id 1 at its end."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def finish(words):
        data = b"".join([*words, end])
        return len(data) // 4, [zlib.crc32(data[i : i + 4 * most]) for i in range(0, len(data), 4 * most)]

    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    found = map_text(rows, vocabulary, "bytes", finish, "doc_tokens long, crcs array<long>")
    start = F.col("pos").cast("long") * most
    return found.select("row.doc_id", "doc_tokens", F.posexplode("crcs").alias("pos", "ids_crc32")).select(
        "doc_id",
        start.alias("start"),
        F.least(F.lit(most).cast("long"), F.col("doc_tokens") - start).alias("length"),
        "ids_crc32",
        "doc_tokens",
    )


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Number the pieces of each length from 0 (column rank).

    A length may own most pieces, so each length is split by a hash into cells; cells are counted
    first, rows are numbered within a cell and moved up by the cells before theirs.
    """
    cells = total // RANKED_TOGETHER + 1
    cell = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(cells)).cast("int")
    pieces = pieces.withColumn("cell", cell)
    counts = pieces.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32")
    return (
        pieces.withColumn("rank", F.row_number().over(within) - 1)
        .join(starts, ["length", "cell"])
        .withColumn("rank", (F.col("rank") + F.col("base")).cast("long"))
        .drop("cell", "base")
    )


def pack(docs: DataFrame, vocabulary: str, most: int = SEQUENCE) -> DataFrame:
    """op10 for (doc_id, text): rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Documents longer than a sequence give full sequences and a rest; rests are packed by
    ``pack_histogram``. Only the histogram, at most ``most`` rows, comes to the driver, and only
    the patterns go back. A null or empty text is the end id alone; ids that repeat or are null are
    documents of their own; an empty table gives no rows; other columns play no part.
    """
    pieces = settle(token_pieces(docs, vocabulary, most), "token-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    where = placements(pack_histogram(histogram, most))
    # one sorted key for length and rank, as ranks are below the row count
    span = max(histogram.values(), default=0) + 1
    keys = where[:, 0] * span + where[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = where[np.searchsorted(keys, length * span + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")],
                    pa.array(at[:, 2] + rank - at[:, 1]),
                    pa.array(at[:, 3]),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked(pieces, sum(histogram.values())).mapInArrow(
        place,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )


def packed_documents(spark, folder: str) -> DataFrame:
    """op10: all documents packed into sequences of 2048."""
    import public_tokenizers

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
