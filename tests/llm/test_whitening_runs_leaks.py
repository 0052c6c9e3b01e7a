"""Whitening, periodic runs and benchmark decontamination against brute-force versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lakeshore.llm import decontamination as dc
from lakeshore.llm import periodic_runs as pr
from lakeshore.llm import queries
from lakeshore.llm import whitening as wh
from lakeshore.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, w string, rid long, j int"


# --- whitening ---------------------------------------------------------------------

def whole(vectors):
    return np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000


def reference(x):
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return centred, values[::-1], vectors[:, ::-1], ((n * x - total) ** 2).sum(axis=1)


def check_whitened(got, vectors, ids, k):
    """``got`` rows against numpy's eigenvectors (either sign)."""
    x = whole(vectors)
    centred, values, directions, deviation = reference(x)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(ids) * k and len(by) == len(got)
    w = np.array([[by[i, c].whitened for c in range(1, k + 1)] for i in ids])
    want = centred @ directions[:, :k] / np.sqrt(values[:k])
    want *= np.sign((want * w).sum(axis=0))
    assert np.abs(w - want).max() < 1e-8
    assert np.abs(w.T @ w / len(ids) - np.eye(k)).max() < 1e-8
    for i, d in zip(ids, deviation.tolist()):
        r = by[i, 1]
        assert r.n == len(ids) and r.deviation == d and 0 <= r.identity_error < 1e-8
        assert abs(r.explained / (values[0] / values.sum()) - 1) < 1e-9


def test_whitening_equals_eigenvectors_and_drops_bad_vectors(spark):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5))).tolist()
    good = [(i, v, 7, 1.0) for i, v in enumerate(base)]
    bad = [(100, None, 1, 1.0), (101, [], 1, 1.0), (102, [1.0, None, 1.0, 1.0, 1.0], 1, 1.0), (103, [float("nan")] * 5, 1, 1.0),
           (104, [float("inf"), 1.0, 1.0, 1.0, 1.0], 1, 1.0), (105, [1.0] * 4, 1, 1.0), (106, [1e300] * 5, 1, 1.0)]
    rows = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>, component int, n double").repartition(5)
    check_whitened(wh.whiten(rows, wh.fit(rows)).collect(), base, list(range(60)), 5)


def test_registered_whitening_equals_numpy(spark):
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    check_whitened(got, [r.embedding for r in rows], [r.vec_id for r in rows], wh.COMPONENTS)


def test_whitening_of_dependent_constant_and_missing_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    line = [(i, [float(i), 2.0 * i, -1.0]) for i in range(9)] * 2 + [(None, [4.0, 8.0, -1.0])]
    rows = spark.createDataFrame(line, kind)
    got = wh.whiten(rows, wh.fit(rows)).collect()
    assert [r.component for r in got] == [1] * 19 and {r.n for r in got} == {19}
    assert abs(got[0].explained - 1) < 1e-12 and sum(r.vec_id is None for r in got) == 1
    for few in ([(1, [1.0, 2.0])], [(1, [3.0]), (2, [3.0])], [(1, None)], []):
        empty = spark.createDataFrame(few, kind)
        assert wh.whiten(empty, wh.fit(empty)).collect() == []


def test_jacobi_on_graded_and_equal_values():
    rng = np.random.default_rng(0)
    turn, _ = np.linalg.qr(rng.normal(size=(8, 8)))
    values = np.array([1e9, 1e6, 1e6, 5.0, 5.0, 1.0, 1e-2, 1e-3])
    got, vectors = wh.principal_components(turn @ np.diag(values) @ turn.T)
    assert np.allclose(got, values, rtol=1e-3) and np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-8)
    assert wh.principal_components(np.zeros((3, 3)))[0].size == 0


def test_deviations_beyond_long_and_wide_sums():
    sums = wh.Sums(1, 3, [5, ])
    assert sums.deviations(np.array([[1], [10 ** 12]])) == [(3 - 5) ** 2, None]
    assert wh.Sums(1, 2, [2 ** 62]).deviations(np.array([[2 ** 61 + 3]])) == [36]


# --- periodic runs ------------------------------------------------------------------

def brute_runs(w):
    found = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i) + 1
    return sorted((a, n, p) for (a, n), p in found.items())


def brute_digest(w):
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    text = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *longest, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode("utf-8")).hexdigest())


def periodic_words(rng, repeats):
    w = []
    for _ in range(rng.randint(0, 6)):
        q, k = rng.randint(1, rng.choice([2, 5, 12, 40])), rng.choice([1, 2, 3, 50])
        base = [f"{rng.randrange(k)}" for _ in range(q)]
        w += base * rng.choice(repeats) + base[:rng.randrange(q)]
    return w


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(5)
    for _ in range(400):
        docs = [[x.encode() for x in periodic_words(rng, [1, 1, 2, 3, 4, 5, 9])] for _ in range(rng.randint(1, 5))]
        assert pr._runs_of(docs) == [brute_runs(d) for d in docs]


def test_proposals_find_each_period_of_a_scale():
    """Every period from 4 on is found by equal contexts, wherever the run stands and whatever is around it."""
    rng = random.Random(1)
    for p in range(4, 70):
        base = [f"w{rng.randrange(10 ** 6)}".encode() for _ in range(p)]
        for extra in (0, 1, p - 1):
            before = [f"a{k}".encode() for k in range(rng.randrange(90))]
            run = base * 4 + base[:extra]
            assert pr._runs_of([before + run + [b"z"]]) == [[(len(before), len(run), p)]]


def test_digest_of_defined_cases(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a", "a " * 6, "x y x y x y x", "x y x y x y x y", "é é é é é é ü", "a\x1fb " * 9, "ab\n" * 5000 + "c " * 5000]
    texts += [" ".join(periodic_words(rng, [1, 3, 4, 6])) for _ in range(40)] + ["p q r s " * 4] * 2
    rows = [(k, t, "w", 1, 2) for k, t in enumerate(texts)] + [(None, "q " * 9, None, None, None)] * 2
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = sorted(((k, *brute_digest(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t, *_ in rows), key=str)
    assert sorted((tuple(r) for r in pr.digest(docs).collect()), key=str) == want
    listed = sorted(((r.doc_id, r.start, r.length, r.period) for r in pr.runs(docs).collect()), key=str)
    assert listed == sorted(((k, *r) for k, t, *_ in rows for r in brute_runs(re.findall(r"[^\x20\x09-\x0D]+", t or ""))), key=str)
    cut = {r.doc_id: r for r in pr.collapse(docs).where("doc_id IS NOT NULL").collect()}
    assert cut[4].text == "a" and cut[5].text == "x y x y x y x" and cut[6].text == "x y" and cut[0].text is None and cut[4].w == "w"
    empty = spark.createDataFrame([], DOCS)
    assert pr.digest(empty).count() == pr.runs(empty).count() == pr.collapse(empty).count() == 0


def test_registered_runs_equal_brute_force_with_planted_tails(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect() if len(r.text or "") < 20_000]
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    planted = 0
    for doc_id, text in docs:
        w, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        assert got[doc_id] == brute_digest(w), doc_id
    assert planted > 5


# --- decontamination ------------------------------------------------------------------

def norm(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_hits(text, items):
    w, hit, names = norm(text), set(), set()
    for item, body in items:
        b = norm(body)
        size = min(10, len(b))
        for s in range(len(b) - size + 1 if b else 0):
            for k in range(len(w) - size + 1):
                if w[k:k + size] == b[s:s + size]:
                    hit |= set(range(k, k + size))
                    names.add("" if item is None else str(item))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def cases():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(12)] + ["É", "ß", "日本", "x9"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, say(rng.choice([10, 11, 25]))) for k in range(6)]
    items += [(10, "only three words"), (11, "single"), (12, "Nine words in this ITEM, so one window, yes!"), (13, None), (14, "..."), (None, say(12)),
              (2, "second row of item two"), (15, items[0][1])]
    docs = [None, "", "!!", "Single", "it is ONLY--three\nwords here", "only three word", "nine words in this item so one window yes " * 3]
    for _ in range(40):
        parts = [say(rng.randrange(12))]
        for _ in range(rng.randrange(3)):
            body = norm(rng.choice(items)[1])
            lo = rng.randrange(3)
            parts += [rng.choice([" ", ", ", "\n"]).join(body[lo:lo + rng.choice([9, 10, 14])]).upper() if body else "", say(rng.randrange(7))]
        docs.append(" ".join(parts))
    docs += [docs[-1], say(400) + " " + items[3][1] + " " + say(400)]
    return items, [(k if k % 9 else None, t, "w", 5, 1) for k, t in enumerate(docs)]


@pytest.mark.parametrize("limit", [dc.BROADCAST_BYTES, 4000])
def test_contamination_equals_brute_force(spark, limit):
    items, rows = cases()
    benchmark = spark.createDataFrame([(k, t, "g") for k, t in items], "item_id long, text string, gram string")
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted((tuple(r) for r in dc.contamination(docs, benchmark, limit=limit).collect()), key=str)
    assert got == sorted(((k, *brute_hits(t, items)) for k, t, *_ in rows), key=str)
    assert sum(r[-1] for r in got) > 10


def test_contamination_of_empty_tables_and_no_python(spark):
    items, rows = cases()
    benchmark, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, DOCS)
    none = dc.contamination(docs, benchmark.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none) and max(r.n_words for r in none) > 800
    assert dc.contamination(docs.limit(0), benchmark).count() == 0
    scan = dc._scan(*dc._numbered(docs), dc.block_table(benchmark.select(dc.words_of(benchmark.text).alias("gram"), benchmark.item_id.alias("gram_id")), [10]), [5])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan


def test_drop_spans_and_documents(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "one two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    leak = "Alpha, beta gamma delta epsilon zeta eta theta iota kappa LAMBDA"
    rows = [(1, f"Before: {leak} -- after.", 3), (1, "clean text", 4), (None, None, 5), (2, "(one two) One, two", 6), (3, leak + "!", 7), (4, "one 2", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hit_spans int")
    cut = {r.hit_spans: r.text for r in dc.drop_spans(docs, benchmark).collect()}
    assert cut == {3: "Before -- after.", 4: "clean text", 5: None, 6: "", 7: "!", 8: "one 2"}
    assert sorted(r.hit_spans for r in dc.drop_documents(docs, benchmark).collect()) == [4, 5, 8]
    assert dc.drop_spans(docs, benchmark).columns == docs.columns
