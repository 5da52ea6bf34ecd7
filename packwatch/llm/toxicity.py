"""Toxicity by a support vector machine with a subsequence string kernel and Nystroem landmarks."""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwatch.llm.common import table
from packwatch.llm.quality_model import held_out

#: Labelled documents of each class used for fitting, at most, chosen by a hash of the id, and the longest used.
FIT_ROWS = 2_000
FIT_CHARS = 20_000
#: Letters of a subsequence, the span in which they may lie, and what each position of the span costs.
LETTERS, SPAN, DECAY = 4, 7, 0.8
#: Bits of a letter in the code of a subsequence; letters beyond share codes.
BITS = 15
LANDMARKS = 400
#: Rounds in which the sentences of toxic documents that show it are chosen anew.
ROUNDS = 4
#: Units of a long word, each overlapping the next by half.
LONGEST = 24
RIDGE = 1e-5
CUT = 0.3
#: Words of a document by which it is judged, the worst ones.
WORST = 4
SEED = 13
#: Natural logarithm, less its sign, of the chance below which an over-represented unit tells by itself.
CLEAR = 12.0
#: Hashes by which copies among the fitted documents are told.
SKETCH = 32
#: Units of clean documents nearest to toxic ones that are remembered from round to round.
HARDEST = 1_500
#: Words whose margin a task remembers.
REMEMBERED = 400_000

#: Three or more single signs in a row, as in a word with gaps between its letters.
SPACED = re.compile(r"(?<!\S)\S(?:[^\S\n]+\S(?!\S)){2,}")
SENTENCES = re.compile(r"(?<=[.!?])\s+|\n")


def words(text: str) -> list[str]:
    """Words of a text in lower case; single letters in a row are one word."""
    text = text.lower()
    found = text.split()
    if SPACED.search(text):
        found += ["".join(m.split()) for m in SPACED.findall(text)]
    return found


def units(word: str) -> list[str]:
    """What of a word is compared: its letters and digits; of long ones overlapping stretches."""
    plain = "".join(c for c in word if c.isalnum())
    if len(plain) <= LONGEST:
        return [plain] if len(plain) >= LETTERS else []
    return [plain[i : i + LONGEST] for i in range(0, len(plain) - LONGEST // 2, LONGEST // 2)]


def subsequences(found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All subsequences of LETTERS letters within SPAN positions: rows (unit, code, weight).

    A weight is DECAY to the power of the positions spanned, so gaps and inserted letters count less, not nothing.
    """
    width = max(map(len, found), default=0) + SPAN
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    codes = np.zeros((len(found), width), dtype=np.int64)
    flat = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(x) for x in found])
    row = np.repeat(np.arange(len(found)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    codes[row, at] = 1 + flat % ((1 << BITS) - 1)
    base = width - SPAN
    out = []
    for steps in combinations(range(1, SPAN), LETTERS - 1):
        unit, start = np.nonzero(codes[:, steps[-1] : steps[-1] + base])
        code = codes[unit, start]
        for step in steps:
            code = (code << BITS) | codes[unit, start + step]
        out.append((unit, code, np.full(len(unit), DECAY ** (steps[-1] + 1))))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def norms(count: int, unit: np.ndarray, code: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Square roots of K(s, s)."""
    order = np.lexsort((code, unit))
    unit, code, weight = unit[order], code[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (code[1:] != code[:-1])])) if len(unit) else []
    if not len(first):
        return np.ones(count)
    total = np.add.reduceat(weight, first)
    found = np.bincount(unit[first], total * total, count)
    return np.sqrt(np.where(found > 0, found, 1.0))


class Units:
    """Units in the space of their subsequences, entries sorted by code so that a column of the kernel is read off."""

    def __init__(self, found: list[str]):
        self.found = found
        unit, code, weight = subsequences(found)
        weight = weight / norms(len(found), unit, code, weight)[unit]
        order = np.argsort(code, kind="stable")
        self.unit, self.weight = unit[order], weight[order]
        self.codes, self.starts = np.unique(code[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(code))

    def column(self, other: str) -> np.ndarray:
        """Normalised kernel of all units with another one."""
        unit, code, weight = subsequences([other])
        known, where = np.unique(code, return_inverse=True)
        value = np.bincount(where, weight, len(known)) / norms(1, unit, code, weight)[0]
        out = np.zeros(len(self.found))
        if not len(self.codes):
            return out
        at = np.minimum(np.searchsorted(self.codes, known), len(self.codes) - 1)
        for i, v in zip(at[self.codes[at] == known].tolist(), value[self.codes[at] == known].tolist(), strict=True):
            part = slice(self.starts[i], self.ends[i])
            out += np.bincount(self.unit[part], self.weight[part] * v, len(out))
        return out


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Normalised kernel of all units on the left with those on the right."""
    rows = Units(left)
    return np.column_stack([rows.column(x) for x in right]) if right else np.zeros((len(left), 0))


def landmarks(rows: Units, weight: np.ndarray, count: int) -> list[int]:
    """Units that span the others, the heavy ones above all: pivots of an incomplete Cholesky factor of the kernel."""
    rest, chosen = np.where(weight > 0, 1.0, 0.0), []
    factor = np.zeros((len(rows.found), count))
    while len(chosen) < count and rest.max(initial=0) > 1e-2:
        best = int(np.argmax(rest * weight))
        column = rows.column(rows.found[best]) - factor @ factor[best]
        column /= math.sqrt(rest[best])
        factor[:, len(chosen)] = column
        rest = rest - column**2
        rest[best] = 0.0
        chosen.append(best)
    return chosen


class Machine:
    """A decision function over units: weights of the landmarks' subsequences and a constant."""

    def __init__(self, marks: list[str], alpha: np.ndarray, bias: float):
        unit, code, weight = subsequences(marks)
        self.codes, where = np.unique(code, return_inverse=True)
        scaled = weight * (alpha / norms(len(marks), unit, code, weight))[unit]
        self.weights = np.bincount(where, scaled, len(self.codes))
        self.bias = bias

    def margins(self, found: list[str]) -> np.ndarray:
        """The margin of each unit, at least that of the empty one."""
        out = np.full(len(found), self.bias)
        for a in range(0, len(found), 20_000):
            some = found[a : a + 20_000]
            unit, code, weight = subsequences(some)
            if not len(code) or not len(self.codes):
                continue
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            total = np.bincount(unit[hit], weight[hit] * self.weights[at[hit]], len(some))
            up = np.flatnonzero(total > 0)
            if len(up):
                some_of = np.isin(unit, up)
                size = norms(len(some), unit[some_of], code[some_of], weight[some_of])
                out[a + up] += total[up] / size[up]
        return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights (the last is the constant) of least squared hinge loss, by Newton steps cut until the loss falls."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = RIDGE * weight.sum() * np.eye(x.shape[1])
    ridge[-1, -1] *= 1e-6
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(w @ ridge @ w + weight @ np.maximum(0, 1 - y * (x @ w)) ** 2)

    now = loss(w)
    for _ in range(100):
        active = y * (x @ w) < 1
        h = x[active] * weight[active][:, None]
        step = np.linalg.solve(ridge + h.T @ x[active], h.T @ y[active]) - w
        size, before = 1.0, now
        while (now := loss(w + size * step)) > before and size > 1e-6:
            size /= 2
        w = w + size * step
        if before - now <= 1e-9 * before:
            break
    return w


def trained(found: list[str], toxic: np.ndarray, weight: np.ndarray) -> Machine:
    """A machine that tells toxic units from others, in the space of the landmarks."""
    rows = Units(found)
    marks = landmarks(rows, weight * toxic, LANDMARKS // 2) + landmarks(rows, weight * ~toxic, LANDMARKS // 2)
    known = np.column_stack([rows.column(found[i]) for i in marks])
    values, vectors = np.linalg.eigh(known[marks])
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    w = svm(known @ root, np.where(toxic, 1.0, -1.0), weight)
    return Machine([found[i] for i in marks], root @ w[:-1], float(w[-1]))


def with_insertions(unit: str, rng: np.random.Generator) -> list[str]:
    """The unit with a letter put into it, in several places, and with one doubled."""
    *places, double = rng.integers(1, len(unit), 4).tolist()
    letters = [chr(97 + int(c)) for c in rng.integers(0, 26, len(places))]
    return [unit[:i] + c + unit[i:] for i, c in zip(places, letters, strict=True)] + [unit[:double] + unit[double - 1] + unit[double:]]


def stems(unit: str) -> set[str]:
    """The unit and its beginnings, for words that differ in their endings only."""
    return {unit[:n] for n in range(4, min(len(unit), 9))} | {unit}


class Model:
    """The machine, and the curve from a document's evidence to its score."""

    def __init__(self, machine: Machine, curve: np.ndarray):
        self.machine, self.curve = machine, curve

    def score(self, margins: list[float]) -> float:
        """The score of a document whose different words have these margins."""
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(evidence(margins, self.machine.bias) @ self.curve)))))


def evidence(margins: list[float], empty: float) -> np.ndarray:
    """What a document is judged by: the margin of its worst word, and those of the next ones that are toxic too."""
    top = [min(m, 1.0) for m in heapq.nlargest(WORST, margins)]
    return np.array([top[0] if top else empty, sum(max(m, 0.0) for m in top[1:]), 1.0])


def fit(rows: list[tuple[str, int]]) -> Model | None:
    """Learn from whole texts and whether they are toxic; None without both classes.

    Labels are of documents, so of a toxic one only some sentences are: it is taken to have at least one, and a
    sentence is shown by its worst unit. Units that are over-represented in toxic documents begin; then machine and choice
    of the showing sentences take turns. A clean document has clean sentences only, and those that come
    nearest to the toxic ones are learned too. Toxic units are also learned with a letter inserted.
    """
    bags = [(list(filter(None, (sentence_units(s) for s in SENTENCES.split(t)))), y) for t, y in rows]
    bags = without_copies([(sentences, y) for sentences, y in bags if sentences])
    if len({y for _, y in bags}) < 2:
        return None
    every = list(dict.fromkeys(u for sentences, _ in bags for s in sentences for u in s))
    number = {u: i for i, u in enumerate(every)}
    bags = [([np.array([number[u] for u in s]) for s in sentences], y) for sentences, y in bags]
    first = association(every, bags)
    # the curve comes from documents that its machine has not learned
    apart = [i % 4 == 3 for i in range(len(bags))]
    some = [b for b, a in zip(bags, apart, strict=True) if not a]
    rest = [b for b, a in zip(bags, apart, strict=True) if a]
    if len({y for _, y in some}) < 2 or len({y for _, y in rest}) < 2:
        some = rest = bags
    machine = learned(every, some, first)
    margin = machine.margins(every)
    known = np.array([evidence(margin[np.unique(np.concatenate(x))].tolist(), machine.bias) for x, _ in rest])
    shape = curve(known, np.array([y for _, y in rest]))
    return Model(learned(every, bags, first), shape)


def without_copies(bags: list) -> list:
    """The documents that do not share half of their sketch, the least hashes of their units, with an earlier one.

    What copies of a toxic document repeat would else look like a mark of toxic documents.
    """
    owner: dict[int, int] = {}
    kept = []
    for i, bag in enumerate(bags):
        sketch = sorted({zlib.crc32(u.encode("utf-8", "surrogatepass")) for s in bag[0] for u in s})[:SKETCH]
        earlier = Counter(owner[h] for h in sketch if h in owner)
        if not earlier or 2 * max(earlier.values()) < len(sketch):
            kept.append(bag)
        for h in sketch:
            owner.setdefault(h, i)
    return kept


def sentence_units(sentence: str) -> list[str]:
    return list(dict.fromkeys(u for w in words(sentence) for u in units(w)))


def association(every: list[str], bags: list) -> np.ndarray:
    """How unlikely (-ln p, about) it is by chance that so many toxic documents hold a unit, or its most telling stem."""
    parts = [stems(u) for u in every]
    seen: tuple[dict[str, int], dict[str, int]] = {}, {}
    total = [0, 0]
    told: set[bytes] = set()
    for sentences, y in bags:
        total[y] += 1
        # a sentence that several documents share counts in the first
        own = [s for s in sentences if s.tobytes() not in told]
        told |= {s.tobytes() for s in own}
        for part in set().union(*(parts[u] for s in own for u in s.tolist())):
            seen[y][part] = seen[y].get(part, 0) + 1
    share = total[1] / sum(total)
    of: dict[str, float] = {}
    for part, a in seen[1].items():
        b = seen[0].get(part, 0)
        # common words of long texts are a little more frequent in either class; a mark is mostly in one
        if 2 * a > (a + b) * (1 + share):
            of[part] = a * math.log(a / (a + b) / share) + (b * math.log(b / (a + b) / (1 - share)) if b else 0.0)
    return np.array([max(of.get(p, 0.0) for p in x) for x in parts])


def learned(every: list[str], bags: list, first: np.ndarray) -> Machine:
    """Machine and showing sentences in turns, beginning with the association."""
    rng = np.random.default_rng(SEED)
    margin, shows, nearest = first, first >= CLEAR, set()
    machine = None
    total = Counter(y for _, y in bags)
    for _ in range(ROUNDS):
        positive: dict[int, int] = {}
        negative: dict[int, int] = dict.fromkeys(nearest, 1)
        for sentences, y in bags:
            # each sentence is shown by its worst unit; a toxic document by its worst sentence
            worst = [int(s[np.argmax(margin[s])]) for s in sentences]
            if y:
                # the sentences that tell by themselves, or else the worst one
                for u in {u for u in worst if shows[u]} or {max(worst, key=lambda u: margin[u])}:
                    positive[u] = positive.get(u, 0) + 1
            else:
                for u in sorted(worst, key=lambda u: -margin[u])[:3] + [worst[int(rng.integers(len(worst)))]]:
                    negative[u] = negative.get(u, 0) + 1
        # a unit that shows documents of both classes belongs where it is three times as frequent, or to the clean ones
        lift = 3 * total[1] / total[0]
        positive = {u: n for u, n in positive.items() if n > lift * negative.get(u, 0)}
        negative = {u: n for u, n in negative.items() if u not in positive}
        if not positive:
            break
        good = sorted(negative, key=lambda u: (-margin[u], every[u]))
        nearest |= set(good[:HARDEST])
        good = good[: 2 * HARDEST] + [good[i] for i in sorted(rng.permutation(len(good))[:1_000].tolist()) if i >= 2 * HARDEST]
        bad = [every[u] for u in positive]
        # a unit counts by the documents that show it, dampened so that rare ones count too
        heavy = [math.sqrt(n) for n in positive.values()]
        made = [(v, w / 2) for u, w in zip(bad, heavy, strict=True) if len(u) >= LETTERS for v in with_insertions(u, rng)]
        found = bad + [v for v, _ in made] + [every[u] for u in good]
        toxic = np.arange(len(found)) < len(bad) + len(made)
        weight = np.concatenate([heavy, [w for _, w in made], np.sqrt([negative[u] for u in good])])
        for side in (toxic, ~toxic):
            if side.any():
                weight[side] *= len(found) / 2 / weight[side].sum()
        machine = trained(found, toxic, weight)
        # beyond 1 a margin says no more; of equals the one that tells by itself shows the sentence
        margin = np.minimum(machine.margins(every), 1.0) + np.minimum(first / 1000, 0.5)
        shows = (margin > 0) & (first >= CLEAR)
    return machine or Machine([], np.zeros(0), -1.0)


def curve(known: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of the logistic curve through labelled documents, with softened labels; more evidence never counts less."""
    bad, good = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (bad + 1) / (bad + 2), 1 / (good + 2))
    w = np.zeros(known.shape[1])
    free = np.ones(len(w), bool)
    ridge = np.array([*[1.0] * (len(w) - 1), 1e-3])
    for _ in range(200):
        x = known[:, free]
        p = 1 / (1 + np.exp(-np.clip(known @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge[free])
        step = np.linalg.solve(hessian, x.T @ (target - p) - ridge[free] * w[free])
        w[free] += np.clip(step, -2, 2)
        if (w[:-1] < 0).any():
            free[:-1] &= w[:-1] > 0
            w[~free] = 0.0
        elif np.abs(step).max() < 1e-8:
            break
    return w


def chosen_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str) -> list[tuple[str, int]]:
    """Texts and labels to learn from, at most FIT_ROWS of each class."""
    ident = F.col(f"`{id_column}`")
    known = labels.select(ident.alias("id"), F.col(f"`{label_column}`").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    rows = docs.select(ident.alias("id"), F.col(f"`{text_column}`").alias("text")).where(F.length("text").between(1, FIT_CHARS))
    usable = known.join(rows.select("id"), "id", "left_semi")
    by_hash = [F.xxhash64(F.lit(SEED), "id"), F.col("id")]
    picked = [usable.where(F.col("label") == y).orderBy(*by_hash).limit(FIT_ROWS).select("id", "label") for y in (0, 1)]
    wanted = F.broadcast(picked[0].unionByName(picked[1]))
    # an id that repeats gives one text
    found = rows.join(wanted, "id").groupBy("id", "label").agg(F.min("text").alias("text")).orderBy("id").collect()
    return [(r["text"], int(r["label"])) for r in found]


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """Rows (id, held_out, score, predicted) of every document, judged by its worst words.

    Learns from at most FIT_ROWS labelled documents of each class that are not held out and have 1 to FIT_CHARS
    characters; null labels, ids with both labels and ids without a document are left out. Without documents of both
    classes all scores are 0. Null and empty texts, and texts without a letter, score like the empty word. Texts are
    read whole, whatever their length, in one pass and without a shuffle; repeated rows are scored each. Other
    columns may have any name; an empty table gives no rows.
    """
    model = fit(chosen_rows(docs, labels, id_column, text_column, label_column))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    if model is None:
        return rows.select("id", held_out(F.col("id")).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        known: dict[str, float] = {}
        empty = model.machine.bias
        for batch in batches:
            if len(known) > REMEMBERED:
                known = {}
            sets = [set(words(t)) if t else () for t in batch.column("text").to_pylist()]
            fresh = [w for w in set().union(*sets) if w not in known] if sets else []
            parts = [units(w) for w in fresh]
            margins = model.machine.margins([u for p in parts for u in p]).tolist()
            at = 0
            for word, part in zip(fresh, parts, strict=True):
                known[word] = max(margins[at : at + len(part)], default=empty)
                at += len(part)
            found = [model.score([known[w] for w in s]) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.float64())], ["id", "score"])

    found = rows.mapInArrow(run, f"id {kind}, score double")
    return found.select("id", held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def toxic_documents(spark, folder: str) -> DataFrame:
    """op13: toxicity score and class of every document."""
    found = scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumnRenamed("id", "doc_id")
