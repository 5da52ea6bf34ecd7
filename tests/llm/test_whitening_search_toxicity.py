"""Whitening, reversed search and toxicity against brute-force versions and held-out labels."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

pytest.importorskip("packwatch.llm")

from compare import connect  # noqa: E402

from packwatch.llm import lexical_search, toxicity, whitening  # noqa: E402
from packwatch.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
# clashing names: those that the operators use themselves
VECTORS = "vec_id long, embedding array<float>, label int, id string, x int, c double, component int"
DOCS = "doc_id long, text string, id int, n int, terms string, score double, rank int, item_id int"


# --- whitening ---


def vectors(seed=3, n=300, dims=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims)) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(n, rows[0][1]), (0, rows[0][1]), (None, rows[1][1])]  # repeated vectors, ids and a null id
    nan, inf = math.nan, math.inf
    rows += [(n + 1, None), (n + 2, [1.0, None, *[0.0] * (dims - 2)]), (n + 3, [nan] * dims), (n + 4, [inf] * dims)]
    return rows + [(n + 5, []), (n + 6, [1e30] * dims), (n + 7, [1.0])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", 1, 0.5, 9) for i, v in rows], VECTORS)


def brute_whitening(rows, dims, count=4):
    usable = [(i, v) for i, v in rows if v and len(v) == dims and None not in v and np.isfinite(v).all() and max(map(abs, v)) < 1e15]
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in usable}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[c - s / n for c, s in zip(v, sums, strict=True)] for v in fit])
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes.T[::-1]
    out = {}
    for i, v in x.items():
        centred = np.array([(n * c - s) / n for c, s in zip(v, sums, strict=True)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
        for k in range(min(count, dims)):
            out[i, k + 1] = (n, deviation, abs(centred @ axes[k]) / math.sqrt(values[k]), values[k] / values.sum())
    return out, len(usable)


@pytest.mark.parametrize("dims", [2, 6])
def test_whitening_equals_eigenvectors(spark, dims):
    rows = vectors(dims=dims)
    got = whitening.whitened(frame(spark, rows)).collect()
    want, usable = brute_whitening(rows, dims)
    assert len(got) == usable * min(4, dims)
    for r in got:
        n, deviation, length, share = want[r["id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(length, rel=1e-9, abs=1e-9)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert r["identity_error"] < 1e-9
    # one sign for all rows: rows of equal vectors agree
    assert len({(r["component"], r["whitened"]) for r in got if r["id"] in (0, 300)}) == min(4, dims)


def test_whitening_of_deficient_rank(spark):
    rng = np.random.default_rng(5)
    flat = rng.integers(-20, 20, (200, 2)) @ rng.integers(-3, 4, (2, 5)) / 256
    found = whitening.whitened(frame(spark, list(enumerate(flat.tolist())))).collect()
    by = {k: [r for r in found if r["component"] == k] for k in (1, 2, 3, 4)}
    assert all(r["whitened"] is not None for k in (1, 2) for r in by[k])
    assert all(r["whitened"] is None for k in (3, 4) for r in by[k])
    assert found[0]["identity_error"] < 1e-9
    assert sum(by[k][0]["explained"] for k in by) == pytest.approx(1)


def test_whitening_of_one_vector_and_none(spark):
    found = whitening.whitened(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found] == [(1, 0, None, None, None)] * 4
    assert whitening.whitened(frame(spark, [(1, None)])).count() == 0
    assert whitening.whitened(frame(spark, [])).count() == 0


def test_whitening_of_badly_scaled_rows(spark):
    """One direction a million times as wide as another, far from the origin: the shift must not blur it."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(rng.normal(size=(400, 2)) * [1e6, 1] + [1e7, 3])]
    found = whitening.whitened(frame(spark, rows)).collect()
    want, _ = brute_whitening(rows, 2)
    for r in found:
        assert abs(r["whitened"]) == pytest.approx(want[r["id"], r["component"]][2], rel=1e-4, abs=1e-4)
    assert found[0]["identity_error"] < 1e-4


def test_deviations_beyond_64_bits_stay_exact():
    x = np.array([[1 << 40, 0], [0, 3]])
    assert whitening.deviations(x, 2, [1 << 40, 3]) == [(1 << 80) + 9] * 2


def test_whitening_query(spark):
    got = QUERIES["op11_whitening"](spark, FOLDER)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, _ = brute_whitening([tuple(r) for r in rows], 64)
    got = got.collect()
    assert len(got) == len(want)
    for r in got:
        n, deviation, length, share = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(length, rel=1e-6, abs=1e-6)
        assert r["explained"] == pytest.approx(share, rel=1e-9) and r["identity_error"] < 1e-9


# --- reversed search ---


def search_texts():
    rng = random.Random(4)
    words = ["Alpha", "beta", "GAMMA", "délta", "ÉPSILON", "zeta9", "日本語", "the", "of"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "-x", "\n"]) for _ in range(rng.randint(1, 40)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " .,;\x00"), (None, "alpha beta beta"), (7, rows[7][1]), (7, rows[7][1])]
    return rows + [(203, "alpha " * 30_000), (204, rows[5][1]), (205, rows[5][1])]


SEARCH_ITEMS = [(1, "alpha ALPHA of"), (2, "délta épsilon"), (3, "日本語 nowhere"), (4, None), (5, "!"), (6, "nowhere"), (7, "beta")]
SEARCH_ITEMS += [(7, "gamma beta"), (None, "zeta9")]


def brute_search(docs, items, best):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = lambda t: [w.translate(lower) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    terms = [(i, split(t)) for i, t in docs]
    terms = [(i, w) for i, w in terms if w]
    n_docs, n_terms = len(terms), sum(len(w) for _, w in terms)
    df = Counter(w for _, ws in terms for w in set(ws))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(split(t))
    out = []
    for item, query in wanted.items():
        scores = []
        for i, ws in terms:
            m, tf = 100 - 90 + (90 * len(ws) * n_docs) // n_terms, Counter(ws)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[q] + 1))) * ((10**9 * tf[q]) // (1000 * tf[q] + 8 * m))
                for q in query
                if tf[q]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=repr)


def search_frames(spark, docs, items):
    docs = spark.createDataFrame([(i, t, 1, 2, "t", 0.5, 3, 4) for i, t in docs], DOCS)
    return docs, spark.createDataFrame([(i, t, 5, 6) for i, t in items], "item_id long, text string, doc_id int, term int")


@pytest.mark.parametrize("postings", [500_000, 3])
def test_search_equals_brute_force(spark, postings):
    docs, items = search_texts(), SEARCH_ITEMS
    got = lexical_search.ranked(*search_frames(spark, docs, items), block_postings=postings).collect()
    want = brute_search(docs, items, 10)
    assert len(want) > 30 and sorted(map(tuple, got), key=repr) == want


def test_search_in_several_steps_and_sums(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "STEP_CELLS", 21)
    monkeypatch.setattr(lexical_search, "EXACT_TERMS", 1)
    got = lexical_search.ranked(*search_frames(spark, search_texts(), SEARCH_ITEMS), best=3).collect()
    assert sorted(map(tuple, got), key=repr) == brute_search(search_texts(), SEARCH_ITEMS, 3)


def test_search_of_empty_tables(spark):
    assert lexical_search.ranked(*search_frames(spark, [], SEARCH_ITEMS)).count() == 0
    assert lexical_search.ranked(*search_frames(spark, [(1, None)], SEARCH_ITEMS)).count() == 0
    assert lexical_search.ranked(*search_frames(spark, [(1, "alpha")], [])).count() == 0


def test_norms_beyond_64_bits():
    assert lexical_search.length_norms(np.array([10**9]), 10**12, 10**15).tolist() == [10 + 90 * 10**6]


def test_search_query_equals_sql(spark):
    got = QUERIES["op12_lexical_search"](spark, FOLDER)
    want = connect(FOLDER).execute(ORACLES["op12_lexical_search"])
    assert got.columns == [d[0] for d in want.description]
    want = want.fetchall()
    assert len(want) > 300 and sorted(map(tuple, got.collect())) == sorted(want)


# --- toxicity ---


def brute_features(unit):
    found = {}
    for places in combinations(range(len(unit)), toxicity.LETTERS):
        span = places[-1] - places[0] + 1
        if span <= toxicity.SPAN:
            key = "".join(unit[p] for p in places)
            found[key] = found.get(key, 0) + toxicity.DECAY**span
    return found


def brute_kernel(a, b):
    x, y = brute_features(a), brute_features(b)
    size = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(v * y.get(k, 0) for k, v in x.items()) / size if size else 0.0


def test_kernel_equals_definition():
    units = ["idiot", "idxiot", "banana", "worthless", "mmmmmmmm", "scum", "ab", "été日本語", "abcdefghijklmnopqrstuvwx"]
    got = toxicity.kernel(units, units)
    want = [[brute_kernel(a, b) for b in units] for a in units]
    assert np.allclose(got, want)


def test_machine_equals_sum_over_landmarks():
    marks, alpha = ["idiot", "scum", "garden"], np.array([1.5, 1.0, -2.0])
    units = ["idiot", "idiots", "garden", "scxum", "tulip", "ab"]
    want = [max(-0.5, -0.5 + sum(a * brute_kernel(u, m) for a, m in zip(alpha, marks, strict=True))) for u in units]
    assert np.allclose(toxicity.Machine(marks, alpha, -0.5).margins(units), want)


def test_svm_finds_the_least_loss():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    y = np.where(x @ [1.0, -2.0, 0.5] + 0.3 * rng.normal(size=200) > 0, 1.0, -1.0)
    weight = rng.uniform(0.5, 2, 200)
    w = toxicity.svm(x, y, weight)

    def loss(w):
        ridge = toxicity.RIDGE * weight.sum() * (w[:3] @ w[:3] + 1e-6 * w[3] ** 2)
        return ridge + weight @ np.maximum(0, 1 - y * (x @ w[:3] + w[3])) ** 2

    assert all(loss(w) <= loss(w + 1e-3 * d) + 1e-9 for d in np.concatenate([np.eye(4), -np.eye(4), rng.normal(size=(50, 4))]))


INSULTS = ["blockhead", "dimwit", "numbskull", "lowlife"]


def toxic_corpus(n=700):
    r = random.Random(6)
    word = lambda: "".join(r.choice(["ka", "ter", "mon", "lis", "ve", "pro", "sun", "dal"]) for _ in range(r.randint(1, 3)))
    rows = []
    for i in range(n):
        sentences = [[word() for _ in range(r.randint(4, 9))] for _ in range(r.randint(3, 8))]
        if toxic := i % 4 == 0:
            r.choice(sentences).insert(2, r.choice(INSULTS).upper() if i % 8 else r.choice(INSULTS))
        rows.append((i, " ".join(" ".join(s).capitalize() + "." for s in sentences), int(toxic)))
    return rows


def toxic_frames(spark, rows, labels=None):
    docs = spark.createDataFrame([(i, t, 1, 2, "t", 0.5, 3, 4) for i, t, *_ in rows], DOCS)
    labels = [(i, y, "x") for i, _, y in rows] if labels is None else labels
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_corpus()
    odd = [(5000, None), (5001, ""), (5002, "... !!"), (None, "monter dalsun"), (5003, "kater " * 60_000 + "you dimwit"), (0, rows[0][1])]
    gaps = ["you b-l-o-c-k-h-e-a-d", "you d i m w i t here", "dim.wit", "numbbskull kater", "such a nuxmbskull", "lowzlife"]
    odd += [(6000 + i, g) for i, g in enumerate(gaps)]
    docs, labels = toxic_frames(spark, rows)
    more, _ = toxic_frames(spark, odd, [])
    # labels that are null, contradict each other or have no document teach nothing
    extra = spark.createDataFrame([(None, 1, ""), (1, 1, ""), (9999, 1, ""), (3, None, "")], labels.schema)
    found = toxicity.scored(docs.unionByName(more), labels.unionByName(extra)).collect()
    assert len(found) == len(rows) + len(odd)
    truth = {i: y for i, _, y in rows}
    held = [(truth[r["id"]], r["predicted"]) for r in found if r["id"] in truth and r["held_out"]]
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.98 * len(held)
    score = {r["id"]: r["score"] for r in found}
    assert all(0 <= s <= 1 for s in score.values())
    assert score[5000] == score[5001] == score[5002] < 0.3 and score[None] < 0.3
    assert score[5003] >= 0.3
    assert sum(score[6000 + i] >= 0.3 for i in range(len(gaps))) >= len(gaps) - 1


@pytest.mark.parametrize("labels", [[], [(i, 0, "") for i in range(40)]])
def test_toxicity_without_both_classes(spark, labels):
    found = toxicity.scored(*toxic_frames(spark, toxic_corpus(40), labels)).collect()
    assert len(found) == 40 and {(r["score"], r["predicted"]) for r in found} == {(0.0, 0)}


def test_toxicity_of_empty_tables(spark):
    assert toxicity.scored(*toxic_frames(spark, [], [])).count() == 0
    _, labels = toxic_frames(spark, toxic_corpus(40))
    docs, _ = toxic_frames(spark, [], [])
    assert toxicity.scored(docs, labels).count() == 0


def test_toxicity_query_on_held_out_labels(spark):
    got = QUERIES["op13_toxicity"](spark, "/root/testdata/sf0.1")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    judged = got.where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic = [r["predicted"] for r in judged if r["toxic"] == 1]
    clean = [r["predicted"] for r in judged if r["toxic"] == 0]
    assert len(toxic) > 50 and sum(toxic) >= 0.85 * len(toxic)
    assert len(clean) > 500 and sum(clean) <= 0.01 * len(clean)
