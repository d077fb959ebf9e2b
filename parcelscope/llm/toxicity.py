"""Toxicity scores (operator 5).

A lexicon is learned from labelled rows: whole words and word stems that occur
in toxic texts and next to never elsewhere. Its trie is intersected with a
Levenshtein automaton of one edit, so misspelled terms are found too. A window
around each hit tells quotation (quotation marks, words of speech or mention)
from use. Counts of hits by kind and context feed a logistic regression.

Defined cases: null and empty texts get the score of a text without hits; a
null id belongs to no training row and gets ``held_out`` null; repeated rows
get equal scores; without labelled rows of both classes every score is the
share of toxic labels (0 without labels); columns besides the named ones are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, cut, documents, per_text

#: At most about so many labelled rows are used for learning.
MAX_LABELLED = 24_000
FOLDS, HELD = 5, 0
#: A term must occur in so many different toxic texts, and so rarely elsewhere,
LEAST_TEXTS = 4
LEAST_SHARE, STEM_SHARE = 0.8, 0.97
#: and by chance so few terms of its frequency would.
BY_CHANCE = 0.3
STEM_LENGTHS = (5, 6, 7, 8)
STEM_WORDS = 4
#: Texts whose terms a worker counts at once.
COUNTED = 2_500
#: The lexicon keeps its most frequent terms up to this size, as a model bound.
MAX_TERMS = 4_000
#: Shorter terms must match exactly.
FUZZY_LEAST = 5
WINDOW_CHARS = 40

WORD = re.compile(r"[^\W\d_]+")
QUOTES = re.compile("[\"'“”„«»‘’]")
# Words that mark a mention, in the corpus' four languages.
MENTION = re.compile(r"\b(?:said|says|called|quoted?|word|term|meaning|sagte|nannte|wort|zitat"
                     r"|dijo|llam[oó]|palabra|cita|dit|appel[eé]|mot|citation)\b")

FEATURES = ("word_used", "stem_used", "fuzzy_used", "word_quoted", "stem_quoted", "fuzzy_quoted")


# ---------------------------------------------------------------- trie and automaton

END, STEM = "", "*"  # keys of a trie node besides its letters


def build_trie(words: list[str], stems: list[str]) -> dict:
    root: dict = {}
    for terms, mark in ((words, END), (stems, STEM)):
        for term in terms:
            node = root
            for ch in term:
                node = node.setdefault(ch, {})
            node[mark] = len(term)
    return root


def _children(node: dict) -> list[dict]:
    return [c for ch, c in node.items() if ch != END and ch != STEM]


def match(word: str, root: dict) -> int:
    """How ``word`` meets the lexicon: 1 a word of it, 2 a stem's continuation,
    3 a word within one edit, 0 not at all.

    The states of the automaton are trie nodes reached without an edit (one at
    most) and with one edit (a set); a word is dropped as soon as both are empty.
    """
    exact: dict | None = root
    edited: dict[int, dict] = {}
    stem = False
    for ch in word:
        after: dict[int, dict] = {}
        for node in edited.values():
            c = node.get(ch)
            if c is not None:
                after[id(c)] = c
        if exact is not None:
            after[id(exact)] = exact  # ch is one letter too many
            for c in _children(exact):
                after[id(c)] = c  # ch stands for another letter
                d = c.get(ch)
                if d is not None:
                    after[id(d)] = d  # a letter is missing before ch
            exact = exact.get(ch)
            if exact is not None and STEM in exact:
                stem = True
        elif not after:
            return 2 if stem else 0
        edited = after
    if exact is not None:
        if END in exact:
            return 1
    if stem:
        return 2
    for node in edited.values():
        if node.get(END, 0) >= FUZZY_LEAST:
            return 3
    if exact is not None:
        for c in _children(exact):  # the last letter is missing
            if c.get(END, 0) >= FUZZY_LEAST:
                return 3
    return 0


class Matcher:
    """Matches with a bounded memory of the words seen."""

    def __init__(self, words: list[str], stems: list[str], keep: int = 400_000):
        self.root, self.keep, self.seen = build_trie(words, stems), keep, {}

    def hits(self, tokens: set[str]) -> dict[str, int]:
        seen, out = self.seen, {}
        for w in tokens:
            k = seen.get(w)
            if k is None:
                if len(seen) >= self.keep:
                    seen.clear()
                k = seen[w] = match(w, self.root) if 3 <= len(w) <= 40 else 0
            if k:
                out[w] = k
        return out


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the window around a hit marks it as quoted or mentioned."""
    before, after = text[max(0, start - WINDOW_CHARS):start], text[end:end + WINDOW_CHARS]
    marks = QUOTES.search(before[-3:]) and QUOTES.search(after[:3])
    return bool(marks or (MENTION.search(before) and (QUOTES.search(before) or QUOTES.search(after))))


def text_features(text: str, m: Matcher) -> list[float]:
    """Hits by kind, used first and quoted after, each as n / (n + 1)."""
    low = text.lower()
    hits = m.hits(set(WORD.findall(low)))
    n = [0.0] * 6
    if hits:
        for w in WORD.finditer(low):
            k = hits.get(w.group())
            if k:
                n[k - 1 + 3 * quoted(low, w.start(), w.end())] += 1
    return [x / (x + 1) for x in n]


# ---------------------------------------------------------------- learning

def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by term and label, summed over runs of rows before they are shuffled."""
    for batch in (b.slice(i, COUNTED) for b in batches for i in range(0, b.num_rows, COUNTED)):
        by: tuple[Counter, Counter] = (Counter(), Counter())
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = {w for w in WORD.findall(text.lower()) if 3 <= len(w) <= 40}
            by[y].update(words)
            by[y].update({f"{w[:n]}*" for w in words for n in STEM_LENGTHS if len(w) > n})
        terms = list(by[0].keys() | by[1].keys()) if by[1] else list(by[0])
        yield pa.RecordBatch.from_pydict({"term": terms, "toxic": [by[1][t] for t in terms],
                                          "clean": [by[0][t] for t in terms]})


def chance(toxic: int, texts: int, base: float) -> float:
    """Probability that of ``texts`` texts at least ``toxic`` are, at this base rate."""
    if toxic <= 0 or base >= 1:
        return 1.0
    if base <= 0:
        return 0.0
    # in logarithms, as the binomial coefficients of frequent terms are beyond a double
    whole = lgamma(texts + 1) + texts * log1p(-base)
    odds = log(base) - log1p(-base)
    out = 0.0
    for k in range(toxic, texts + 1):
        term = exp(whole - lgamma(k + 1) - lgamma(texts - k + 1) + k * odds)
        out += term
        # beyond the mean the terms only fall
        if k > base * texts and term <= out * 1e-15:
            break
    return min(out, 1.0)


def learn_lexicon(train: DataFrame) -> tuple[list[str], list[str]]:
    """(words, stems) from a frame (toxic, text) of bounded size.

    Equal texts count once, so copies don't make their words look typical.
    """
    once = train.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(
        F.max("toxic").alias("toxic"), F.max("text").alias("text"))
    counts = (once.select("toxic", "text").mapInArrow(_counts, "term string, toxic long, clean long")
              .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .withColumn("texts", F.col("toxic") + F.col("clean")).filter(F.col("texts") >= LEAST_TEXTS))
    counts = cut(counts, "toxicity-terms")
    share = F.when(F.col("term").endswith("*"), STEM_SHARE).otherwise(LEAST_SHARE)
    rows = (counts.filter(F.col("toxic") >= LEAST_TEXTS).filter(F.col("toxic") >= share * F.col("texts"))
            .orderBy(F.desc("toxic"), "term").limit(MAX_TERMS).collect())
    # terms by number of texts: a histogram no longer than the bounded sample
    as_many = {r.texts: r["count"] for r in counts.groupBy("texts").count().collect()}
    base = once.agg(F.avg("toxic")).first()[0] or 0.0
    rows = [r for r in rows if chance(r.toxic, r.texts, base) * sum(
        n for t, n in as_many.items() if t >= r.texts) <= BY_CHANCE]
    words = [r.term for r in rows if not r.term.endswith("*")]
    stems = []
    for s in sorted((r.term[:-1] for r in rows if r.term.endswith("*")), key=len):
        if s.startswith(tuple(stems)):
            continue
        # a stem stands for several words; one word's own beginning doesn't count
        if sum(w.startswith(s) for w in words) >= STEM_WORDS or not any(w.startswith(s) for w in words):
            stems.append(s)
    return words, stems


FEATURE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.float64()))])


def features(docs: DataFrame, words: list[str], stems: list[str]) -> DataFrame:
    """(doc_id, features) of a frame (doc_id, text)."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(words, stems)
        run = per_text(lambda ids, texts: {"doc_id": ids,
                                           "features": [text_features(t, m) for t in texts]},
                       FEATURE_SCHEMA)
        yield from run(batches)
    return docs.mapInArrow(score, "doc_id long, features array<double>")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic",
                   max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted and the features of every row of ``docs``.

    Labels of rows whose crc32(doc_id) mod 5 is 0 are never read for learning.
    """
    docs = documents(docs, id_col, text_col)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    train_labels = (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                                  F.col(label_col).cast("int").alias("toxic"))
                    .filter(F.col("toxic").isin(0, 1) & (fold != HELD))
                    .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = bounded_sample(train_labels, "doc_id", max_labelled)
    train = cut(docs.join(sample, "doc_id").select("doc_id", "toxic", "text"), "toxicity-train")
    words, stems = learn_lexicon(train.select("toxic", "text"))
    seen = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    found = features(docs, words, stems)
    if len(seen) == 2:
        ids = train.select("doc_id", "toxic")
        fit_on = cut(features(train.select("doc_id", "text"), words, stems).join(ids, "doc_id")
                     .select(F.col("toxic").cast("double").alias("label"),
                             array_to_vector("features").alias("features")), "toxicity-features")
        model = LogisticRegression(regParam=1e-3, standardization=False, maxIter=50).fit(fit_on)
        z = F.lit(float(model.intercept))
        for i, w in enumerate(model.coefficients):
            z = z + F.col("features")[i] * F.lit(float(w))
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    else:
        score = F.lit(float(1 in seen))
    return (found.withColumn("score", score)
            .select("doc_id", (fold == HELD).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    *[F.col("features")[i].alias(n) for i, n in enumerate(FEATURES)]))
