"""Toxicity score: a weighted lexicon matched by one Aho-Corasick automaton.

``fit`` learns the lexicon and its calibration from labelled rows, ``score``
applies it to every text.

* Folding maps letters one to one: lower case, accents dropped, look-alike
  Cyrillic, Greek and full-width letters to Latin, digits and signs that stand
  for letters ("1d10t", "$cum") to those letters.
* A sign between letters may also end a word ("idiot!stupid").  Such a run of
  letters and signs is read three ways - all signs folded, "!" as an end, every
  sign as an end - and the reading with the largest weight counts (of equal
  ones the first).
* A word is a run of letters after folding.  Lexicon entries are words and
  word beginnings; of the entries that match at a word's start the longest
  counts.  An entry inside a longer word does not match.
* A hit inside an exception phrase ("trash can") does not count.  Besides a few
  given phrases, ``fit`` learns pairs of words around a hit that at least
  ``min_docs`` clean texts have, and no larger a share of the toxic ones.
* score = logistic(a + b*x1 + c*x2), with x1 = log(1 + W) and
  x2 = log(1 + 100 W / words) for the summed weight W of the hits.

Statistics: ``fit`` uses labelled rows of its ``train`` condition only.  Its
``max_rows`` bounds them: beyond that many, rows are thinned by a hash of
doc_id.  Texts that occur more than once count once.  The lexicon holds
at most ``max_entries`` entries, so the model sent to the tasks is bounded.

Defined results: a null or empty text scores like a text without hits; very
long texts are matched whole; repeated rows score alike; an empty table gives
an empty result; without any labelled toxic row the lexicon is empty and all
rows get the same score (the smoothed rate of toxic labels).  Extra columns
are kept.  Labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layercake.llm.common import arrow_batches, materialize, steady

# Signs that stand for letters, and look-alike letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l"}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "disgusting smell", "stupid mistake")

SHORTEST, LONGEST = 3, 24


@lru_cache(1)
def _table() -> dict[int, str]:
    """Folding table; a sign folds only inside a word, see ``fold``."""
    table = {}
    for c in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(c).lower())[0]
        table[c] = base if len(base) == 1 else chr(c)
    for c in range(0xFF21, 0xFF5B):
        table[c] = unicodedata.normalize("NFKC", chr(c)).lower()
    for k, v in LOOKALIKES.items():
        table[ord(k)] = v
        if len(k.upper()) == 1:
            table[ord(k.upper())] = v
    return {k: v for k, v in table.items() if len(v) == 1}


# a sign next to a letter on its right, or between letters and signs that lead to a letter
_SIGNS = "[" + re.escape("".join(SIGNS)) + "]"
_SIGN = re.compile(rf"(?<!{_SIGNS}){_SIGNS}++(?=[^\W\d_])")
_RUN = re.compile(rf"(?:[^\W\d_]|{_SIGNS})++")
_BETWEEN = re.compile(rf"[^\W\d_]{_SIGNS}++[^\W\d_]")


def _letters(text: str) -> str:
    return text.lower().translate(_table())


def _signs(text: str) -> str:
    return _SIGN.sub(lambda m: "".join(SIGNS[c] for c in m[0]), text)


def fold(text: str) -> str:
    """Folded text of the same length in words; see the module text."""
    return _signs(_letters(text))


_WORD = re.compile(r"[^\W\d_]+")


def entries(text: str) -> set[str]:
    """Words ("idiot ") and word beginnings ("idio") of a text, as lexicon candidates."""
    found = set()
    for w in set(_WORD.findall(fold(text))):
        if SHORTEST <= len(w) <= LONGEST:
            found.add(w + " ")
        found.update(w[:n] for n in range(SHORTEST + 1, min(len(w), 10)))
    return found


@dataclass(frozen=True)
class Lexicon:
    """weights: entry -> weight; an entry ending in a space is a whole word."""
    weights: dict[str, float]
    coefficients: tuple[float, float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS


class Matcher:
    """Weight and word count of a text."""

    def __init__(self, lexicon: Lexicon):
        self.automaton = ahocorasick.Automaton()
        self.size = 0
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(" " + entry, (len(entry) + 1, weight))
            self.size += 1
        for phrase in lexicon.exceptions:
            self.automaton.add_word(f" {fold(phrase)} ", (len(phrase) + 2, None))
            self.size += 1
        if self.size:
            self.automaton.make_automaton()

    def _hits(self, words: list[str]) -> tuple[dict[int, float], list[int]]:
        """Weight of each hit outside exceptions by the place of its word's
        leading space, and the places of all hits."""
        best: dict[int, tuple[int, float]] = {}
        spared = []
        for end, (size, weight) in self.automaton.iter(" " + " ".join(words) + " "):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif size > best.get(start, (0, 0.0))[0]:
                best[start] = (size, weight)
        starts = sorted(best)
        out = {s for a, b in spared for s in starts[bisect_left(starts, a):bisect_left(starts, b)]}
        return {s: w for s, (_, w) in best.items() if s not in out}, starts

    def _best_reading(self, run: re.Match) -> str:
        if not _BETWEEN.search(run[0]):
            return run[0]
        ended = re.sub(_SIGNS, " ", run[0])
        readings = [_signs(run[0]), _signs(run[0].replace("!", " ")), ended]
        return max(readings, key=lambda r: sum(self._hits(_WORD.findall(r))[0].values()))

    def words(self, text: str) -> list[str]:
        text = _letters(text)
        if self.size and _BETWEEN.search(text):
            text = _RUN.sub(self._best_reading, text)
        return _WORD.findall(_signs(text))

    def weigh(self, text: str) -> tuple[float, int]:
        words = self.words(text)
        if not self.size or not words:
            return 0.0, len(words)
        return sum(self._hits(words)[0].values()), len(words)

    def phrases(self, text: str) -> set[str]:
        """Pairs of neighbouring words of which one is a hit."""
        words = self.words(text)
        if not self.size or not words:
            return set()
        places = dict(zip(accumulate([0, *(len(w) + 1 for w in words)]), range(len(words))))
        found = set()
        for at in map(places.__getitem__, self._hits(words)[1]):
            found.update(" ".join(words[k:k + 2]) for k in (at - 1, at) if 0 <= k < len(words) - 1)
        return found


def _features(weight, words):
    weight, words = np.asarray(weight, float), np.asarray(words, float)
    return np.stack([np.ones_like(weight), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))], 1)


def _weigh(df: DataFrame, lexicon: Lexicon, text: str) -> DataFrame:
    """``df`` with the columns _weight and _words."""
    schema = T.StructType(df.schema.fields + [T.StructField("_weight", T.DoubleType()),
                                              T.StructField("_words", T.LongType())])
    at = df.columns.index(text)

    @steady
    def run(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            got = [matcher.weigh(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64())],
                [*b.schema.names, "_weight", "_words"])

    return df.mapInArrow(run, schema)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column | None = None,
        max_rows: int = 20_000, max_entries: int = 2_000, min_docs: int = 6, min_share: float = 0.01) -> Lexicon:
    """Learn a lexicon from ``labels`` (doc_id, toxic) on rows where ``train`` holds.

    An entry must occur in ``min_docs`` different toxic texts and in
    ``min_share`` of them."""
    arrow_batches(spark)
    labelled = labels.where("toxic is not null and doc_id is not null")
    if train is not None:
        labelled = labelled.where(train)
    labelled = labelled.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = labelled.count()
    if total > max_rows:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30))
                                  < int((1 << 30) * max_rows / total))
    rows = docs.where("text is not null").select("doc_id", "text").join(labelled, "doc_id")
    sample = materialize(rows.groupBy(F.md5("text").alias("key"))
                         .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")), spark, "toxic_sample")
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic:
        rate = 0.5 / (clean + 1)
        return Lexicon({}, (float(np.log(rate / (1 - rate))), 0.0, 0.0))

    def spread(batches):
        for b in batches:
            found = [sorted(entries(t)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([e for es in found for e in es], pa.string())], ["entry"])

    def counted(flag: int) -> DataFrame:
        return (sample.where(F.col("toxic") == flag).select("text").mapInArrow(spread, "entry string")
                .groupBy("entry").agg(F.count("*").alias("n")))

    frequent = counted(1).where(F.col("n") >= max(min_docs, min_share * toxic))
    rate = (F.col("n") + 0.5) / (toxic + 1) / ((F.coalesce("clean", F.lit(0)) + 0.5) / (clean + 1))
    top = (frequent.join(counted(0).withColumnRenamed("n", "clean"), "entry", "left")
           .withColumn("odds", F.log(rate)).where("odds > 2")
           .withColumn("gain", F.col("odds") * F.sqrt(F.col("n").cast("double")))
           .orderBy(F.desc("gain"), "entry").limit(max_entries).collect())
    weights = _select({r["entry"]: (float(r["odds"]), r["n"]) for r in top})
    lexicon = Lexicon(weights, (0.0, 0.0, 0.0))
    exceptions = EXCEPTIONS + _learn_exceptions(sample, lexicon, toxic, clean, min_docs, max_entries)
    lexicon = Lexicon(weights, (0.0, 0.0, 0.0), exceptions)
    got = _weigh(sample.select("toxic", "text"), lexicon, "text").select("toxic", "_weight", "_words").collect()
    y = np.array([r[0] for r in got], float)
    beta = logistic(_features([r[1] for r in got], [r[2] for r in got]), y)
    return Lexicon(weights, tuple(float(b) for b in beta), exceptions)


def _learn_exceptions(sample: DataFrame, lexicon: Lexicon, toxic: int, clean: int, min_docs: int,
                      most: int) -> tuple[str, ...]:
    """Phrases of ``sample`` (toxic, text) around hits that speak for a clean text; at most ``most``."""
    def spread(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            found = [sorted(matcher.phrases(t)) for t in b.column(1).to_pylist()]
            flags = np.repeat(np.array(b.column(0).to_pylist(), np.int32), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(flags), pa.array([p for f in found for p in f], pa.string())],
                                             ["toxic", "phrase"])

    counted = (sample.select("toxic", "text").mapInArrow(spread, "toxic int, phrase string").groupBy("phrase")
               .agg(F.count_if(F.col("toxic") == 0).alias("c"), F.count_if(F.col("toxic") == 1).alias("t")))
    share = (F.col("t") + 0.5) / (toxic + 1) / ((F.col("c") + 0.5) / (clean + 1))
    rows = counted.where(F.col("c") >= min_docs).where(share <= 1).orderBy(F.desc("c"), "phrase").limit(most).collect()
    return tuple(r["phrase"] for r in rows if r["phrase"] not in EXCEPTIONS)


def _select(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Of entries that begin alike, the shortest, lengthened as long as it
    still occurs in nineteen of twenty of the same texts: "idiot ", not "idio"."""
    starts = lambda e: (e[:n] for n in range(SHORTEST, len(e)))
    weights = {}
    for entry in found:
        if not any(s in found for s in starts(entry)):
            same = [e for e in found if e.startswith(entry) and found[e][1] >= 0.95 * found[entry][1]]
            best = max(same, key=lambda e: (len(e), e))
            weights[best] = found[best][0]
    return weights


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps; slopes stay at or above zero."""
    keep = np.ones(x.shape[1], bool)
    while True:
        beta = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            h = (x[:, keep] * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x[:, keep] + ridge * np.eye(keep.sum())
            step = np.linalg.solve(h, x[:, keep].T @ (y - p) - ridge * beta[keep])
            beta[keep] += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        bad = [i for i in range(1, len(beta)) if keep[i] and beta[i] < 0]
        if not bad:
            return beta
        keep[bad[0]] = False


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with score (double, 0 to 1)."""
    arrow_batches(docs.sparkSession)
    a, b, c = lexicon.coefficients
    w, n = F.col("_weight"), F.greatest(F.col("_words"), F.lit(1))
    z = F.lit(a) + b * F.log1p(w) + c * F.log1p(100 * w / n)
    return _weigh(docs, lexicon, text).withColumn("score", 1 / (1 + F.exp(-z))).drop("_weight", "_words")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
