"""Bounded samples, languages, rate fits, repeated ids and padding, against brute force."""

import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshore.llm import jaccard_join, langid, mixing, packing
from lakeshore.llm.common import sample_per_class, texts_of


# --- samples --------------------------------------------------------------------------

def test_texts_of_a_repeated_id_stay_within_the_sample(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.format_string("text %d", "id").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(8, "other"), (8, "other"), (None, "none")], "doc_id long, text string"))
    chosen = spark.createDataFrame([(7, 1), (8, 0), (8, 0), (9, 0)], "doc_id long, label int")
    got = texts_of(docs, chosen, 400)
    assert {(r.label, r["count"]) for r in got.groupBy("label").count().collect()} == {(1, 400), (0, 2)}
    again = texts_of(docs.repartition(7), chosen, 400)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_labels_are_chosen_by_rows_then_name(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.format_string("l%03d", F.when(F.col("id") < 800, F.col("id") % 4).otherwise(F.col("id") % 400)).alias("label"))
    got = {r.label: r["count"] for r in sample_per_class(rows, 50, 6).groupBy("label").count().collect()}
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(6).collect()
    assert got == {r.label: min(50, r["count"]) for r in counts}


def test_many_languages_are_learned_and_the_rest_named(spark):
    rng = random.Random(1)
    langs = {f"x{k:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüñçабвгдежз") for _ in range(rng.randint(3, 8))) for _ in range(12)] for k in range(30)}
    rows = [(i, " ".join(rng.choice(langs[lang]) for _ in range(30)), lang) for i, lang in enumerate(sorted(langs) * 20)]
    rows += [(7, f"repeated {i}", "x00") for i in range(300)] + [(None, "no id", "x01"), (5000, None, "x02")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, per_lang=40)
    assert model.langs == sorted(langs) and langid.unlearned(docs).count() == 0
    got = langid.identify(docs.where("text not like 'repeated%' and doc_id <> 5000"), model)
    right = got.join(docs.select("doc_id", "lang"), "doc_id").where("lang_pred = lang").count()
    assert right > 0.95 * 600
    few = langid.fit(docs, per_lang=40, max_langs=5)
    left = {r.lang for r in langid.unlearned(docs, 5).collect()}
    assert len(few.langs) == 5 and set(few.langs) | left == set(langs) and not set(few.langs) & left


def test_und_without_letters():
    model = langid.LanguageModel(["a"], np.zeros((langid.BUCKETS, 1), np.float32), np.zeros(1, np.float32), 0.0)
    for text in ("", "①② ½ Ⅷ ²", "12 345", "!?", "٣٤", "_", "́"):
        assert not any(unicodedata.category(c).startswith("L") for c in text)
        assert model.predict(text)[0] == "und", text
    for text in ("é", "日本", "a²", "ª", "ʰ"):
        assert model.predict(text)[0] == "a", text
    assert langid.letters("x² Ⅷy_z 3d") == " x y z d "


# --- rates ------------------------------------------------------------------------------

def dense_residual(t, p, targets, max_rate, steps=40_000):
    """Least half squared residual by many plain projected gradient steps."""
    curve = np.linalg.eigvalsh((p * t[:, None]).T @ p)[-1]
    r = np.ones(len(t))
    y, momentum = r, 1.0
    for _ in range(steps):
        new = np.clip(y - p @ (((t * y) @ p) - targets) / curve, 0, max_rate)
        grow = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        y, r, momentum = new + (momentum - 1) / grow * (new - r), new, grow
    return 0.5 * np.square((t * r) @ p - targets).sum()


@pytest.mark.parametrize("alpha, anchor, max_rate", [((1, .1, .1), None, 1.0), ((30, 30, 30), None, 1.0), ((300, 300, 300), None, 1.0),
                                                     ((80, 10, 10), None, 1.0), ((5, 1, 3), "good", 2.0)])
def test_rates_reach_the_least_residual(spark, alpha, anchor, max_rate):
    rng = np.random.default_rng(5)
    p = rng.dirichlet(alpha, 1500)
    t = rng.integers(0, 400, 1500).astype(float)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens long, p array<double>")
    rates = mixing.fit_rates(rows, mixing.DOMAINS, max_rate=max_rate, anchor=anchor)
    targets = np.array(rates.targets)
    least = dense_residual(t, p, targets, max_rate)
    assert rates.residuals[-1] <= least + 0.5 * (mixing.CLOSE * targets.sum()) ** 2 + 1e-6
    assert all(b <= a * (1 + 1e-9) + 1e-9 for a, b in zip(rates.residuals, rates.residuals[1:]))
    assert len(rates.steps) < mixing.ITERATIONS
    got = np.array([r.r for r in rows.select(rates.column().alias("r")).collect()])
    assert got.min() >= 0 and got.max() <= max_rate
    assert np.allclose((t * got) @ p, rates.totals, rtol=1e-6, atol=1e-3)


def test_mix_keeps_rows_as_their_rates_say(spark):
    rows = [(i, "clean words here " * 3 if i % 2 else "buy $$$ now ### !!!", "p", i) for i in range(400)] + [(None, None, "p", 1), (3, "", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, scored string, copies int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs, labels, {"good": 0.9, "poor": 0.1}, anchor="good")
    assert got.columns == docs.columns and got.schema == docs.schema
    kept = [r.doc_id for r in got.collect()]
    assert {i for i in range(400) if i % 2} <= set(kept) and len(kept) < 330 and len(kept) == len(set(kept)) + kept.count(3) - 1
    assert mixing.mix(docs.limit(0), labels).count() == 0
    own_p = docs.withColumnRenamed("scored", "p")
    assert mixing.mix(own_p, labels).columns == own_p.columns


# --- ids that repeat or are missing --------------------------------------------------------

@pytest.mark.parametrize("kind", ["missing", "equal"])
def test_near_groups_with_one_id_for_all(spark, kind):
    """Texts are paired by row, not by id: the number of rows moved stays in proportion."""
    rng = random.Random(9)
    base = [[f"w{rng.randrange(5000)}" for _ in range(40)] for _ in range(40)]
    texts = [" ".join(w) for w in base for _ in range(3)] + [" ".join(w[:38] + ["x", "y"]) for w in base] + ["only here " * 9] * 5
    doc_id = None if kind == "missing" else 7
    docs = spark.createDataFrame([(doc_id, t) for t in texts], "doc_id long, text string")
    read = jaccard_join.read_sets(docs, 8)
    sets = read.where("part is null").select("doc_id", "print", "n", "node")
    nodes = sorted(r.node for r in sets.select("node").distinct().collect())
    pairs = spark.createDataFrame([(a, b) for a, b in zip(nodes, nodes[1:])], "a long, b long")
    links = {(r.a, r.b) for r in jaccard_join.confirm(docs, sets, pairs).collect()}
    by_node = {jaccard_join.node_of(jaccard_join.shingles(t)): set(jaccard_join.shingles(t).tolist()) for t in texts}
    assert links == {(a, b) for a, b in zip(nodes, nodes[1:]) if 100 * len(by_node[a] & by_node[b]) >= 80 * len(by_node[a] | by_node[b])}
    got = jaccard_join.near_groups(docs).collect()
    assert len(got) == len(texts) and {r.component_id for r in got} == {doc_id}
    kept = [r.text for r in jaccard_join.drop_near_copies(docs).collect()]
    assert len(kept) == 41


# --- packing -----------------------------------------------------------------------------------

@pytest.mark.parametrize("piece", ["这是一个没有标点的句子我们继续写", "यह एक वाक्य है जिसमें कोई विराम नहीं ", "col | 12 | 3.5 | x ; "])
def test_padding_of_texts_without_sentence_ends(spark, piece):
    docs = spark.createDataFrame([(i, piece * (1300 // len(piece) * 2 // 3 + i % 7)) for i in range(200)], "doc_id long, text string").coalesce(1)
    got = packing.pack(docs).groupBy("sequence_id").agg(F.max("sequence_tokens").alias("n"), F.max("padding").alias("padding")).collect()
    padded, tokens = sum(r.padding for r in got), sum(r.n for r in got)
    assert padded < 0.05 * (padded + tokens)


def test_sentence_ends_of_other_scripts():
    from lakeshore.llm.tokens import byte_bpe

    bpe = byte_bpe()
    for text in ("One.", "yes!", "line\n", "a?", 'said."'):
        assert bpe.sentence_end[bpe.ids(text)[-1]], text
    assert not bpe.sentence_end[bpe.ids("word")[-1]] and re.fullmatch(r"\S+", "word")
