"""Quality rules from tokeniser fertility, with rejection bands per language or script.

Two public vocabularies read the words of every text: a byte-level BPE gives
characters per token and token entropy, a sentencepiece BPE with byte fallback
gives characters per token and the share of fallback bytes.  Text unlike the
prose of its own language (shouted, symbol-ridden, looping, or of characters
the vocabulary lacks) leaves the band that the whole corpus sets for the
language, or, without one, for the script: quartiles widened by a multiple of
their distance, never narrower than a stated width.  Texts of similar token
count share a band, because entropy depends on length; a band of few rows takes
in the nearest size classes, up to the whole language, failing that the same of
the script, then of the corpus (all of it, if it has few rows).  A text is rejected
outside twice the band of any measure, below the band of entropy, or outside a
characters-per-token band when its entropy lies in the lowest quarter as well
(numbers, names and addresses make good prose less fertile, but not monotonous).

Defined cases: NULL or empty text has no words, all counts 0, and fails the base
rule; a NULL language falls back to the script of the text; repeated rows are
judged alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import WORD, materialise, text_list
from lakeshore.llm.tokens import TOKENIZER_DIR, byte_bpe, piece_bpe

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Band per measure: quartiles widened by this many inter-quartile ranges, and the least half width around the median.
SPREAD = 2.0
LEAST_WIDTH = {"byte_chars_per_token": 0.15, "piece_chars_per_token": 0.15, "fallback_share": 0.05, "entropy": 0.08}
#: Sides of the band that count: entropy and characters per token may be too low or too high, fallback only too high.
UPPER_ONLY = ("fallback_share",)
MEASURES = tuple(LEAST_WIDTH)
#: Texts whose words are looked up together.
BLOCK = 200
#: Parts that the rows of one band are dealt to, as one language may hold most rows.
SALTS = 64
#: Rows a band needs; with fewer, neighbouring size classes join it, then the script's and at last the whole corpus's rows are taken.
MIN_ROWS = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_tokens long, script string, " + \
    ", ".join(f"{m} double" for m in MEASURES)

_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)], np.uint64)


def repeated_words(words: list[str]) -> int:
    """Words inside a window of WINDOW words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h += ids[k:k + n] * _MULTIPLIERS[k]
    _, back, times = np.unique(h, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[back] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


@lru_cache(maxsize=65536)
def _script(c: str) -> str:
    name = unicodedata.name(c, "").split(" ")[0]
    return name if c.isalpha() and name else ""


def script_of(words: list[str]) -> str:
    """The script of most words by their first letter-like character ('' without letters)."""
    counts: dict[str, int] = {}
    for c, n in Counter(map(itemgetter(0), words)).items():
        s = _script(c)
        if s:
            counts[s] = counts.get(s, 0) + n
    return max(sorted(counts), key=counts.get) if counts else ""


def measure_all(texts: list[str], tokenizer_dir: str = TOKENIZER_DIR) -> Iterator[tuple]:
    """``measure`` of every text, learning the words of a block of texts at a time."""
    for at in range(0, len(texts), BLOCK):
        block = [(t, WORD.findall(t)) for t in texts[at:at + BLOCK]]
        piece_bpe(tokenizer_dir).learn(set().union(*(w for _, w in block)))
        for text, words in block:
            yield measure(text, words, tokenizer_dir)


def measure(text: str, words: list[str], tokenizer_dir: str = TOKENIZER_DIR) -> tuple:
    """The base counts and tokeniser measures of one text with these words."""
    n = len(words)
    if not n:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, "", 0.0, 0.0, 0.0, 0.0)
    chars = sum(map(len, words))
    by_byte, by_piece = byte_bpe(tokenizer_dir).word_ids(words), piece_bpe(tokenizer_dir)
    pieces = by_piece.ids(words)
    _, times = np.unique(by_byte, return_counts=True)
    p = times / len(by_byte)
    entropy = float(-(p * np.log2(p)).sum() / max(1.0, np.log2(len(by_byte))))
    return (n, chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeated_words(words), len(by_byte), script_of(words),
            chars / len(by_byte), chars / max(1, len(pieces)), float(by_piece.fallback[pieces].mean()) if len(pieces) else 0.0, entropy)


def measure_table(docs: DataFrame, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = SCHEMA.format(kind=kind) + ", lang string"
    types = [pa.int64()] * 6 + [pa.string()] + [pa.float64()] * len(MEASURES)
    names = [*COUNTS, "n_tokens", "script", *MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(measure_all(text_list(batch.column(1)), tokenizer_dir))
            columns = list(zip(*rows)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types)), batch.column(2)],
                                             names=["doc_id", *names, "lang"])

    return docs.select("doc_id", "text", F.col("lang").cast("string")).mapInArrow(run, schema)


def _levels() -> F.Column:
    """Where a row may be judged: among its language (or script), its script, all rows."""
    keys = (F.col("grp"), F.col("script"), F.lit(""))
    return F.array(*(F.struct(F.lit(k).alias("level"), key.alias("key")) for k, key in enumerate(keys)))


def reaches(counts: DataFrame) -> DataFrame:
    """(grp, script, size, level, key, reach): the first level, and there the fewest size classes to either side, with MIN_ROWS rows.

    ``counts`` has the rows of each (grp, script, size) as ``n``.  Every one of
    its rows gets a band: the last level takes what there is.
    """
    placed = counts.select("grp", "script", "size", "n", F.explode(_levels()).alias("p")).select("grp", "script", "size", "n", "p.*")
    cells = placed.groupBy("level", "key", "size").agg(F.sum("n").alias("n"))
    other = cells.select("level", "key", F.col("size").alias("other"), F.col("n").alias("m"))
    far = (cells.join(other, ["level", "key"]).groupBy("level", "key", "size", F.abs(F.col("size") - F.col("other")).alias("d"))
           .agg(F.sum("m").alias("m")))
    held = F.sum("m").over(Window.partitionBy("level", "key", "size").orderBy("d"))
    reach = (far.withColumn("held", held).groupBy("level", "key", "size")
             .agg(F.min(F.when(F.col("held") >= MIN_ROWS, F.col("d"))).alias("enough"), F.max("d").alias("all")))
    reach = reach.withColumn("reach", F.coalesce("enough", F.when(F.col("level") == 2, F.col("all")))).where("reach is not null")
    best = placed.join(reach, ["level", "key", "size"]).groupBy("grp", "script", "size").agg(F.min(F.struct("level", "key", "reach")).alias("b"))
    return best.select("grp", "script", "size", "b.*")


def bands(rows: DataFrame) -> DataFrame:
    """(grp, script, size, lo_*, hi_*): the band of each language or script and size class, from all rows that pass the base rule."""
    passed = rows.where(~F.col("base_failed"))
    chosen = materialise(reaches(passed.groupBy("grp", "script", "size").agg(F.count(F.lit(1)).alias("n"))), "reaches")
    # At most a few rows for each language with MIN_ROWS rows.
    wanted = F.broadcast(chosen.select("level", "key", "size", "reach").distinct())
    near = passed.select(F.col("size").alias("own"), *MEASURES, F.explode(_levels()).alias("p")).select("own", *MEASURES, "p.*")
    near = near.join(wanted, ["level", "key"]).where(F.abs(F.col("own") - F.col("size")) <= F.col("reach"))
    quartiles = [F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(f"q_{m}") for m in MEASURES]
    got = near.groupBy("level", "key", "size", "reach").agg(*quartiles)
    out = ["grp", "script", "size", F.col("q_entropy")[0].alias("q1_entropy")]
    for m, least in LEAST_WIDTH.items():
        q1, q2, q3 = (F.col(f"q_{m}")[k] for k in range(3))
        for k, name in ((1, "in"), (2, "out")):
            low, high = F.least(q1 - k * SPREAD * (q3 - q1), q2 - k * least), F.greatest(q3 + k * SPREAD * (q3 - q1), q2 + k * least)
            out += [F.when(F.lit(m in UPPER_ONLY), F.lit(float("-inf"))).otherwise(low).alias(f"lo_{name}_{m}"), high.alias(f"hi_{name}_{m}")]
    return chosen.join(got, ["level", "key", "size", "reach"]).select(*out)


def judge(docs: DataFrame, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the measures, for every row."""
    rows = measure_table(docs, tokenizer_dir).withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "grp": F.coalesce("lang", "script"),
        "size": F.floor(F.log(2.0, F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int"),
    })
    rows = materialise(rows, "fertility")
    parts = bands(rows).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id", "n_tokens", "entropy"), F.lit(SALTS)).cast("int")
    joined = rows.withColumn("_salt", salt).join(parts, ["grp", "script", "size", "_salt"], "left")
    within = lambda m, name: F.coalesce(F.col(m).between(F.col(f"lo_{name}_{m}"), F.col(f"hi_{name}_{m}")), F.lit(True))
    monotonous = F.coalesce(F.col("entropy") < F.col("q1_entropy"), F.lit(False))
    rejected = F.coalesce(F.col("entropy") < F.col("lo_in_entropy"), F.lit(False))
    rejected |= monotonous & ~(within("byte_chars_per_token", "in") & within("piece_chars_per_token", "in"))
    for m in MEASURES:
        rejected |= ~within(m, "out")
    return joined.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"), "n_tokens", "script", *MEASURES)
