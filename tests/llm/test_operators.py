"""Small tables with NULLs, empty and long texts, ties, repeated rows and clashing columns, against brute force."""

import hashlib
import re
import zlib
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from lakeshore.llm import (chunk_dedup, fertility, html_content, jaccard_join, langid, mixing, packing, pseudonyms,
                           quality_gam, toxicity)
from lakeshore.llm.components import components
from lakeshore.llm.tokens import byte_bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, n long, copy_id string, draw double"
PROSE = "The quick brown fox jumps over the lazy dog and runs far away from the old grey barn near a river bank today"


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang if i is None or i % 5 else None, "s", 0, "x", 1, "c", 0.5) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    words = PROSE.split()
    near = " ".join(words * 3 + ["alpha"] * 0 + [f"w{k}" for k in range(60)])
    texts = [(1, PROSE), (2, "  " + PROSE.replace(" ", "\n") + " "), (2, PROSE), (3, None), (4, ""), (5, " \t\n"),
             (None, PROSE), (6, near), (7, near + " tail"), (8, "one two"), (9, "ONE two"), (10, "日本語 テスト"),
             (11, "lorem ipsum " * 30_000), (12, near.replace("w30", "v30")), (12, near), (13, "1 2 3 !!! ###")]
    return docs_of(spark, texts)


def test_exact_groups_match_brute_force(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    best = {}
    for r in rows:
        key = (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)
        best[plain(r.text)] = min(best.get(plain(r.text), (key, r.doc_id)), (key, r.doc_id), key=lambda x: x[0])
    got = chunk_dedup.exact_groups(odd).collect()
    assert len(got) == len(rows)
    size = {}
    for r in rows:
        size[plain(r.text)] = size.get(plain(r.text), 0) + 1
    sha = {hashlib.sha256(p.encode()).hexdigest(): p for p in best}
    for g in got:
        p = sha[g.text_sha256]
        assert (g.keep_id, g.group_size) == (best[p][1], size[p])
    assert sum(g.kept for g in got) == len(best)
    left = chunk_dedup.drop_copies(odd)
    assert left.columns == odd.columns and left.count() == len(best)


def _sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_near_groups_match_brute_force(spark, odd):
    rng = np.random.default_rng(5)
    base = [f"t{k}" for k in range(40)]
    extra = [(100 + k, " ".join(w if rng.random() > 0.02 else f"x{k}" for w in base[: 8 + k % 30])) for k in range(60)]
    docs = odd.where("doc_id is not null").unionByName(docs_of(spark, extra))
    rows = docs.select("doc_id", "text").collect()
    sets = [_sets(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    want = sorted((r.doc_id, len(s), min(rows[k].doc_id for k in range(len(rows)) if find(k) == find(i)))
                  for i, (r, s) in enumerate(zip(rows, sets)))
    got = sorted(tuple(r) for r in jaccard_join.near_groups(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == want


@pytest.mark.parametrize("words, place, links", [(12, 11, 0), (24, 2, 0), (24, 0, 1)])
def test_templates_with_one_varying_word_make_no_pairs(spark, words, place, links):
    """200 texts that differ in one word: either none is linked and no pair is made, or all are and the stars suffice."""
    n = 200
    texts = [(k, " ".join(f"v{k}" if j == place else f"t{j}" for j in range(words))) for k in range(n)]
    docs = docs_of(spark, texts)
    read = jaccard_join.read_sets(docs, 8)
    heavy = jaccard_join.heavy_tokens(jaccard_join.token_counts(read))
    lists = jaccard_join.list_rows(docs, jaccard_join.Fronts(heavy, 8, jaccard_join.MAX_BOUNDARY)).localCheckpoint()
    none = spark.createDataFrame([], "a long, b long")
    stars = jaccard_join.star_pairs(lists)
    roots = components(stars if links else none)
    assert jaccard_join.remaining_pairs(lists, roots, none).count() == 0
    assert (n - 1 <= stars.count() < 8 * n) if links else stars.count() == 0
    assert len({r.component_id for r in jaccard_join.near_groups(docs).collect()}) == (1 if links else n)


def test_one_row_of_each_component_stays(spark):
    """NULL and repeated ids: rows are judged by (id, set), not by id alone."""
    words = PROSE.split()
    a = " ".join(words * 3 + [f"a{k}" for k in range(60)])
    c, x, y, z = (" ".join(f"{name}{k}" for k in range(40)) for name in "cxyz")
    texts = [(None, a), (5, a + " tail"), (None, c), (7, x + " end"), (7, y), (3, x), (None, None), (9, ""),
             (4, z), (4, z + " end"), (4, z.upper()), (4, z), (None, "only null"), (None, "ONLY  null")]
    docs = docs_of(spark, texts)
    out = jaccard_join.drop_near_copies(docs)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    left = [(i, t) for i, t in got if i != 4 and (t or "").lower().split() != ["only", "null"]]
    assert out.columns == docs.columns
    assert left == sorted([(5, a + " tail"), (None, c), (7, y), (3, x), (None, None), (9, "")], key=str)
    assert len([t for i, t in got if i == 4]) == 1 and len(got) == len(left) + 2


def test_boundary_follows_cost():
    assert jaccard_join.choose_boundary({}, 0.0) == 0
    sizes = dict.fromkeys(range(1, 61), 100)
    assert jaccard_join.choose_boundary(sizes, 0.0) <= jaccard_join.choose_boundary(sizes, 2.0)


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (90, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100: 90}


def test_packing_is_an_exact_partition(spark, odd):
    bpe = byte_bpe()
    rows = odd.select("doc_id", "text").collect()
    got = packing.pack(odd).collect()
    total = sum(len(bpe.whole.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(g.length for g in got) == total
    for s in {g.sequence_id for g in got}:
        at = 0
        for g in sorted((g for g in got if g.sequence_id == s), key=lambda g: g.offset):
            assert g.offset == at
            at += g.length
        assert at <= packing.WINDOW
    (only,) = [r for r in rows if r.doc_id == 11]
    ids = np.array([*bpe.whole.encode(only.text, add_special_tokens=False).ids, 1], "<u4")
    pieces = sorted((g for g in got if g.doc_id == 11), key=lambda g: g.start)
    assert [g.start for g in pieces] == np.cumsum([0, *(g.length for g in pieces[:-1])]).tolist()
    assert all(g.ids_crc32 == zlib.crc32(ids[g.start:g.start + g.length].tobytes()) and g.doc_tokens == len(ids) for g in pieces)


def test_plan_cuts_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(30):
        places = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 14))])
        cost = rng.choice([0.0, 3.0], len(places))
        best = [0.0] + [1e9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                n = int(places[j] - places[i])
                if n <= 16:
                    best[j] = min(best[j], best[i] + packing.padding(n, 16) + cost[j] + packing.PER_WINDOW)
        cuts = [0, *packing.plan_cuts(places, cost, 16)]
        got = sum(packing.padding(int(places[b] - places[a]), 16) + cost[b] + packing.PER_WINDOW for a, b in zip(cuts, cuts[1:]))
        assert got == pytest.approx(best[-1])


def test_byte_bpe_equals_the_public_tokenizer():
    bpe = byte_bpe()
    for t in ["", "a  b\n\n c", "naïve £5 it's 'S", "\x1c\x1f\x85 x", "日本語", "<|endoftext|> y", PROSE]:
        assert bpe.ids(t).tolist() == bpe.whole.encode(t, add_special_tokens=False).ids


def test_base_counts_match_brute_force(spark, odd):
    loop = " ".join(["a b c d e f g h"] * 5) + " z\nsame line\nsame line\n\n#$"
    docs = odd.unionByName(docs_of(spark, [(50, loop)]))
    got = {r.doc_id: r for r in fertility.judge(docs).collect()}
    assert len(got) and fertility.judge(docs).count() == docs.count()
    for r in docs.select("doc_id", "text").where("doc_id in (1, 3, 4, 8, 13, 50)").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        seen = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i:i + 8]), []).append(i)
        covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
        lines = [x for x in (r.text or "").split("\n") if x.strip(" \t\n\v\f\r")]
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r.text or ""), len(lines) - len(set(lines)), len(covered))
        assert g.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (g.kept and g.base_failed)


def test_thin_bands_fall_back(spark):
    """Long junk in a small corpus, and junk of a rare language, leave a band of neighbouring sizes, of the script or of the corpus."""
    rng = np.random.default_rng(8)
    vocabulary = [w for w in PROSE.lower().split()] + "house water people small light under stone green morning letter paper music".split()
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    junk = lambda n: " ".join(f"{rng.integers(10 ** 9):x}#$|{rng.integers(10 ** 9):x}" for _ in range(n))
    rows = [(k, prose(60 + k % 20), "en") for k in range(60)] + [(101, junk(900), "en"), (102, junk(60), "xx")]
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r.kept for r in fertility.judge(docs).collect()}
    assert len(got) == len(rows) and not got[101] and not got[102]
    assert sum(got[k] for k in range(60)) >= 55
    counts = spark.createDataFrame([("en", "LATIN", 6, 30), ("en", "LATIN", 7, 5), ("en", "LATIN", 12, 1), ("xx", "LATIN", 7, 3), ("yy", "HAN", 9, 2)],
                                   "grp string, script string, size int, n long")
    got = {(r.grp, r.size): (r.level, r.key, r.reach) for r in fertility.reaches(counts).collect()}
    assert got == {("en", 6): (0, "en", 0), ("en", 7): (0, "en", 1), ("en", 12): (0, "en", 6), ("xx", 7): (1, "LATIN", 1), ("yy", 9): (2, "", 3)}
    few = {r.doc_id: r.kept for r in fertility.judge(docs.where("doc_id < 3")).collect()}
    assert len(few) == 3


def test_language_id(spark, odd):
    model = langid.train([("en", np.concatenate(list(langid.buckets(b" the quick brown fox ")))),
                          ("de", np.concatenate(list(langid.buckets(" über straße käse ".encode()))))] * 20, [])
    assert model.predict("the brown quick fox")[0] == "en" and model.predict("käse über")[0] == "de"
    got = {r.doc_id: r for r in langid.identify(odd, langid.fit(odd)).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und" and got[3].score == 0.0
    assert got[1].lang_pred == "en" and 0 <= got[1].score <= 1
    kept = langid.keep_identified(odd, langid.fit(odd))
    assert kept.columns == odd.columns and kept.where("text is null").count() == 0


def test_classifiers_learn_and_take_odd_rows(spark, odd):
    calm = [(k, f"{PROSE} number {k} rests calmly") for k in range(1000, 1060)]
    rude = [(k, f"{PROSE} number {k} you idiot clown") for k in range(1060, 1120)]
    junk = [(k, "a | b | c " * (k % 9 + 3)) for k in range(1120, 1180)]
    docs = odd.unionByName(docs_of(spark, calm + rude + junk))
    labels = spark.createDataFrame([(i, int(i < 1120), int(1060 <= i < 1120)) for i in range(1000, 1180)] + [(None, 1, 1), (1, None, None)],
                                   "doc_id long, quality int, toxic int")
    n = docs.count()
    tox = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert all(tox[i].predicted == (1060 <= i < 1120) for i in range(1000, 1120)) and tox[3].score == tox[4].score
    good = {r.doc_id: r for r in quality_gam.score(docs, quality_gam.fit(docs, labels)).collect()}
    assert np.mean([good[i].predicted == (i < 1120) for i in range(1000, 1180)]) > 0.95 and 0 <= good[3].score <= 1
    rated = mixing.rate_documents(docs, labels)
    assert rated.count() == n and rated.where("rate < 0 or rate > 1 or rate is null").count() == 0
    assert mixing.mix(docs, labels).columns == docs.columns
    none = labels.where("false")
    for out in (toxicity.score(docs, toxicity.fit(docs, none)), quality_gam.score(docs, quality_gam.fit(docs, none)),
                mixing.rate_documents(docs, none)):
        assert out.count() == n


def test_identity_swap_moves_no_score():
    assert toxicity.counterfactual("The women sang. Men left.", 0) == "The men sang. girls left."
    x, twin = [[0, 1], [1], [0], [1]] * 20, [[0, 2], [2], [0], [2]] * 20
    w, _ = toxicity.fit_weights(x, twin, np.array([1, 0, 1, 0] * 20, float), 3, 0.5)
    assert w[0] > 1 and abs(w[1] - w[2]) < 0.1


def test_rates_reach_feasible_targets(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([1, 1], 400)
    rows = spark.createDataFrame([(int(t), [float(a), float(b)]) for t, (a, b) in zip(rng.integers(1, 50, 400), p)], "tokens long, p array<double>")
    rates = mixing.fit_rates(rows, ("good", "poor"), {"good": 0.7, "poor": 0.3}, max_rate=4.0, anchor="good")
    assert np.allclose(rates.totals, rates.targets, rtol=0.05)
    assert all(r.v == pytest.approx(rates.of(r.p)) for r in rows.select("p", rates.column().alias("v")).collect())


def test_pseudonyms_round_trip_and_link(spark, odd):
    text = ("card 4111 1111 1111 1111, again 4111111111111111, bad 4111111111111112, on 2022-11-14 or 14.11.2022, not 2022-02-30, "
            "ip 10.0.0.1, call +1 (988) 555-2485 or +44 20 7946 0958, DE89 3704 0044 0532 0130 00, 123-45-6789, Ann.3@mail.example.com")
    new, found = pseudonyms.Pseudonyms().text(text)
    assert pseudonyms.Pseudonyms(undo=True).text(new)[0] == text and "4111111111111112" in new and "2022-02-30" in new
    for old in ("4111 1111 1111 1111", "2022-11-14", "10.0.0.1", "555-2485", "7946 0958", "0532 0130", "123-45-6789", "Ann.3@"):
        assert old not in new
    cards = re.findall(r"card ([\d ]+), again (\d+)", new)[0]
    assert cards[0].replace(" ", "") == cards[1] and pseudonyms.luhn_digit(cards[1][:-1]) == cards[1][-1]
    permute = pseudonyms.Permutation(b"k")
    for n in (2, 3, 10, 97):
        moved = [permute("t", n, x) for x in range(n)]
        assert sorted(moved) == list(range(n)) and all(a != b for a, b in enumerate(moved))
        assert [permute("t", n, y, undo=True) for y in moved] == list(range(n))
    got = {r.doc_id: r.text for r in pseudonyms.pseudonymise(odd).collect()}
    assert got[3] is None and got[1] == PROSE


def test_pseudonyms_beside_other_digits():
    card, iban, phone = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332", "+44 20 7946 0958"
    work, back = pseudonyms.Pseudonyms(), pseudonyms.Pseudonyms(undo=True)
    alone = {v: work.text(v)[0] for v in (card, iban, phone, "+1 988 555 2485", "345-678-9012")}
    cases = [(card, "{} 12/25"), (card, "{} 123"), (card, "2 {}"), (card, "99 {} 12"), (card, "1234 99 {}"), (card, "{}-12"),
             (iban, "{} EUR"), (iban, "{} BANK CODE"), (iban, "AB12 {}"), (phone, "{} 12"), (phone, "{} 4111"),
             ("+1 988 555 2485", "{} 12"), ("345-678-9012", "12 {} 55")]
    for value, shape in cases:
        old = f"see {shape.format(value)}, please"
        new, found = work.text(old)
        assert new == f"see {shape.format(alone[value])}, please" and sum(found.values()) == 1, (old, new)
        assert back.text(new)[0] == old
    both = f"{phone} {card} 12/25, {card} {card}"
    assert work.text(both)[0] == f"{alone[phone]} {alone[card]} 12/25, {alone[card]} {alone[card]}"
    rng = np.random.default_rng(4)
    for _ in range(300):
        body = "".join(map(str, rng.integers(0, 10, 15)))
        number = body + pseudonyms.luhn_digit(body)
        old = f"{rng.integers(0, 999)} {' '.join(number[k:k + 4] for k in range(0, 16, 4))} {rng.integers(0, 999)}"
        new, _ = work.text(old)
        assert new != old and back.text(new)[0] == old
    assert work.text("1 2 3 4 " * 5)[0].count(" ") == 20


def test_html_main_text(spark):
    model = html_content.train(html_content.labelled_pages())
    page = ('<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>'
            '<div class="ad">Buy now, it is cheap.</div><article><h1>A  head</h1><p><b>First &amp; best\n text.<br><p>Second one, longer than that.</p>'
            '</article><section class="comments"><p>I do not agree with this at all.</p></section><footer>&copy; site</footer></body></html>')
    assert model.extract(page) == "A head\nFirst & best text.\nSecond one, longer than that."
    right = total = 0
    for h in html_content.labelled_pages(60, seed=99):
        p = html_content.parse(h)
        m = model.marginals(p)
        right += sum((m[n] > 0.5) == (p.labels[n] == 1) for n, _ in p.runs)
        total += len(p.runs)
    assert right / total > 0.97
    pages = spark.createDataFrame([(1, "u", page), (None, None, None), (2, "u", ""), (3, "u", "<p>cut <a hre"), (1, "u", page)],
                                  "page_id long, url string, html string")
    got = html_content.extract(pages).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)


def test_tree_marginals_equal_enumeration():
    model = html_content.train(html_content.labelled_pages(40), epochs=2)
    page = html_content.parse("<div><p>Some words here.</p><ul><li>x</li></ul></div>")
    node = [model.bias + sum(model.weights.get(f, 0.0) for f in fs) for fs in html_content.node_features(page)]
    n = len(node)
    weight = np.zeros((n, 2))
    for code in range(2 ** n):
        y = [(code >> k) & 1 for k in range(n)]
        s = model.root[y[0]] + sum(node[k] * y[k] for k in range(n)) + sum(model.edge[y[page.parents[k]], y[k]] for k in range(1, n))
        for k in range(n):
            weight[k, y[k]] += np.exp(s)
    assert np.allclose(model.marginals(page), weight[:, 1] / weight.sum(axis=1))


def test_empty_tables(spark, odd):
    empty = odd.where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (chunk_dedup.exact_groups(empty), jaccard_join.near_groups(empty), packing.pack(empty), fertility.judge(empty),
                langid.identify(empty, langid.fit(empty)), pseudonyms.pseudonymise(empty), mixing.rate_documents(empty, labels),
                toxicity.score(empty, toxicity.fit(empty, labels)), quality_gam.score(empty, quality_gam.fit(empty, labels))):
        assert out.count() == 0


def test_pipeline_keeps_clean_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"


def test_sample_per_class_is_the_first_by_hash(spark):
    from pyspark.sql import functions as F

    from lakeshore.llm.common import sample_per_class

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    want = [r.doc_id for label in (0, 1)
            for r in rows.where(F.col("label") == label).orderBy(F.xxhash64("doc_id")).limit(700).collect()]
    got = sample_per_class(rows, 700, 2).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert sample_per_class(rows.limit(0), 700).count() == 0


def test_near_groups_send_texts_in_small_batches(spark, odd, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    real = jaccard_join.materialise
    monkeypatch.setattr(jaccard_join, "materialise", lambda df, name: seen.append(int(df.sparkSession.conf.get(key))) or real(df, name))
    before = spark.conf.get(key)
    jaccard_join.named_sets(odd)
    assert seen and max(seen) <= 2000 and spark.conf.get(key) == before
