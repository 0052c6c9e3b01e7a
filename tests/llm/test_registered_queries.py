"""The registered queries themselves, on the small tables: contract columns by brute force, held-out rows of the labels."""

import re
import unicodedata
import zlib

import numpy as np
import pytest

from lakeshore.llm.queries import QUERIES
from lakeshore.llm.tokens import byte_bpe

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def run(spark, prefix, sf):
    (name,) = [q for q in QUERIES if q.startswith(prefix)]
    return [r.asDict() for r in QUERIES[name](spark, sf).collect()]


def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_op1_base_counts(spark):
    docs, got = documents(spark, SMALL), run(spark, "op1_", SMALL)
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        text = docs[r["doc_id"]].text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        twice = {w for w in windows if windows.count(w) > 1} if len(set(windows)) < len(windows) else set()
        repeated = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
        want = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
                "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
                "base_failed": len(words) < 20 or 100 * len(repeated) > 30 * len(words)}
        assert {k: r[k] for k in want} == want, r["doc_id"]
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("prefix, label, modulus, at, cut", [("op3_", "quality", 4, 2, 0.7), ("op10_", "toxic", 5, 0, 0.5)])
def test_labels_held_out(spark, prefix, label, modulus, at, cut):
    docs, got = documents(spark, LARGER), run(spark, prefix, LARGER)
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect() if r[label] is not None}
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        assert r["held_out"] == (remainder(r["doc_id"], modulus) == at)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
    held = [(labels[r["doc_id"]], r["predicted"], r["score"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    ones, zeros = ([s for y, _, s in held if y == k] for k in (1, 0))
    better = np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros])
    right = np.mean([y == p for y, p, _ in held])
    print(prefix, len(held), len(ones), right, better)
    assert right >= 0.93 and better >= 0.93


def test_op5_held_out(spark):
    docs, got = documents(spark, LARGER), run(spark, "op5_", LARGER)
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    hits = []
    for r in got:
        d = docs[r["doc_id"]]
        assert r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1
        lettered = any(unicodedata.category(c).startswith("L") for c in d.text or "")
        assert (r["lang_pred"] == "und") == (not lettered), r["doc_id"]
        if r["held_out"] and d.lang is not None and lettered:
            hits.append(r["lang_pred"] == d.lang)
    print("op5", len(hits), np.mean(hits))
    assert np.mean(hits) >= 0.98


def test_op7_round_trip(spark):
    docs, got, bpe = documents(spark, SMALL), run(spark, "op7_", SMALL), byte_bpe().whole
    ids = {k: np.array([*bpe.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4") for k, d in docs.items()}
    reach, windows = dict.fromkeys(docs, 0), {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        whole = ids[r["doc_id"]]
        assert r["start"] == reach[r["doc_id"]] and r["doc_tokens"] == len(whole) and r["length"] > 0
        reach[r["doc_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(whole[r["start"]:r["start"] + r["length"]].tobytes())
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert reach == {k: len(v) for k, v in ids.items()}
    sizes = []
    for pieces in windows.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        sizes.append(sum(n for _, n in pieces))
    assert max(sizes) <= 2048
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    print("op7 padding", padding / sum(sizes))
    assert padding < 0.1 * sum(sizes)
