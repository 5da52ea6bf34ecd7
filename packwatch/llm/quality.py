"""Quality rules as a short-circuit cascade, in DataFrame expressions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwatch.llm.common import WHITE, settle, table

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows of the sample on which rules are timed, on average.
SAMPLE_ROWS = 2000
TIMED_RUNS = 2


@dataclass(frozen=True)
class Rule:
    """A name and an expression over the measures and the text that is true for a bad document."""

    name: str
    rejects: Column


def bind(value: Column, body) -> Column:
    """An expression over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")


def _tail(items: Column, by: int) -> Column:
    return F.slice(items, by + 1, F.greatest(F.size(items) - by, F.lit(0)))


def _front(items: Column, by: int) -> Column:
    return F.slice(items, 1, F.greatest(F.size(items) - by, F.lit(0)))


def _paired(items: Column, by: int) -> Column:
    """Hash of each item with the one ``by`` places on."""
    return F.zip_with(_front(items, by), _tail(items, by), lambda a, b: F.xxhash64(a, b))


def covered_by_repeats(windows: Column, width: int = WINDOW) -> Column:
    """Positions lying in windows that occur twice or more, from the hash of each window.

    Windows are sorted by hash; those with an equal neighbour are taken back to text order,
    and each covers ``width`` positions less those of the next that overlaps it.
    """

    def flagged(rows: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(rows, i)["h"] == x["h"], F.lit(False))
        return F.array_sort(
            F.transform(
                F.filter(
                    F.transform(rows, lambda x, i: F.struct(x["i"].alias("i"), (same(x, i - 1) | same(x, i + 1)).alias("again"))),
                    lambda x: x["again"],
                ),
                lambda x: x["i"],
            )
        )

    def covered(places: Column) -> Column:
        step = lambda p, i: F.least(F.lit(width), F.coalesce(F.get(places, i + 1) - p, F.lit(width)))
        return F.aggregate(F.transform(places, step), F.lit(0), lambda a, b: a + b)

    rows = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return bind(bind(rows, flagged), covered)


def measured(docs: DataFrame) -> DataFrame:
    """Rows (record, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WHITE}]"))
    words = (
        docs.withColumn("words", words_of(text))
        .withColumn("lines", lines)
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("n_lines", F.size("lines").cast("long"))
        .drop("words", "lines")
    )
    pairs = _paired(F.col("hashes"), 1)
    windows = bind(bind(pairs, lambda x: _paired(x, 2)), lambda x: _paired(x, 4))
    return (
        words.withColumn("windows", windows)
        .withColumn("word_chars", F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn(
            "n_repeat_words",
            F.when(F.size(F.array_distinct("windows")) < F.size("windows"), covered_by_repeats(F.col("windows")))
            .otherwise(0)
            .cast("long"),
        )
        .drop("windows")
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def standard_rules() -> list[Rule]:
    """Rules for documents that pass the base ones; each leaves ordinary prose of any language alone."""
    words, chars, text = F.col("n_words"), F.col("word_chars"), F.col("text")
    hashes = F.col("hashes")
    same_as_next = lambda h: F.size(F.filter(F.zip_with(_front(h, 1), _tail(h, 1), lambda a, b: a == b), lambda x: x))
    return [
        Rule("symbols", F.col("n_symbols") > 0.2 * words),
        Rule("word_length", ~F.when(words > 0, chars / words).otherwise(0).between(2.0, 15.0)),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("exclamations", F.length(text) - F.length(F.translate(text, "!", "")) > 0.3 * words),
        Rule("capitals", F.regexp_count(text, F.lit("\\p{Lu}")) > 0.4 * chars),
        Rule("digits", F.regexp_count(text, F.lit("[0-9]")) > 0.4 * chars),
        Rule("stutter", same_as_next(hashes) > 0.3 * words),
    ]


def only(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition holds, without computing its columns again.

    A filter is pushed below the projections it reads, and every mention of a column there becomes
    a copy of the whole expression. Exploding an array of the row, or of nothing, stays above them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.select(F.explode(F.when(condition, F.array(row))).alias("_row")).select("_row.*")


def ordered_by_profit(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules by share rejected per second on a sample, best first.

    Each rule is timed alone on the stored sample; the order changes the cost of the
    cascade, never its verdict. Rules that reject nothing there come last, cheapest first.
    """
    if not rules:
        return []
    shares = sample.agg(*[F.avg(F.coalesce(r.rejects, F.lit(False)).cast("double")).alias(r.name) for r in rules]).first()

    def seconds(rule: Rule) -> float:
        start = time.perf_counter()
        sample.agg(F.sum(rule.rejects.cast("int"))).collect()
        return time.perf_counter() - start

    cost = {r.name: max(min(seconds(r) for _ in range(TIMED_RUNS)), 1e-4) for r in rules}
    return sorted(rules, key=lambda r: (-(shares[r.name] or 0.0) / cost[r.name], cost[r.name]))


def passes(rules: list[Rule]) -> Column:
    """True if no rule rejects; a rule is computed only where those before it did not reject.

    A rule that is null for a row does not reject it.
    """
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(False)).otherwise(verdict)
    return verdict


def judged(docs: DataFrame, rules: list[Rule] | None = None, text_column: str = "text") -> DataFrame:
    """Measures and verdict of every document: record, the measures, base_failed, kept.

    record is a struct of the input's columns, whatever their names. A null or empty text has
    no words and fails; rows that repeat are judged alike; an empty table gives no
    rows. Texts are read whole. There is no shuffle but that of the sample's few figures.
    """
    rules = standard_rules() if rules is None else rules
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    share = min(1.0, SAMPLE_ROWS / max(docs.count(), 1))
    sample = settle(only(measured(rows.sample(share, 7)).drop("record"), ~base_failed()), "rule-sample")
    good = passes(ordered_by_profit(sample, rules))
    return (
        measured(rows)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(good))
        .drop("text", "hashes", "n_lines")
    )


def judged_documents(spark, folder: str) -> DataFrame:
    """op8: measures and verdict of every whole document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(docs).select("record.doc_id", *columns)


def kept_documents(docs: DataFrame) -> DataFrame:
    """Documents that pass; same columns."""
    good = only(judged(docs).select("record", "kept"), F.col("kept"))
    return good.select(*[F.col(f"record.`{c}`").alias(c) for c in docs.columns])


JUDGED_SQL = rf"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), p AS (
  SELECT rid, unnest(list_transform(range(1, len(w) - {WINDOW - 2}),
                                    lambda i: {{'i': i, 'h': array_to_string(w[i:i + {WINDOW - 1}], ' ')}})) AS x
  FROM w
), g AS (
  SELECT rid, x.i AS i, count(*) OVER (PARTITION BY rid, hash(x.h), x.h) AS c FROM p
), r AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM g WHERE c > 1
), m AS (
  SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n FROM r GROUP BY rid
), b AS (
  SELECT w.doc_id, t, w AS ws, l, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(m.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN m USING (rid)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
         OR n_symbols > 0.2 * n_words
         OR word_chars < 2.0 * n_words OR word_chars > 15.0 * n_words
         OR 2 * n_dup_lines > len(l)
         OR length(t) - length(replace(t, '!', '')) > 0.3 * n_words
         OR length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) > 0.4 * word_chars
         OR length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) > 0.4 * word_chars
         OR len(list_filter(range(1, greatest(n_words, 1)), lambda i: ws[i] = ws[i + 1])) > 0.3 * n_words) AS kept
FROM b
"""
