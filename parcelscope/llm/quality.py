"""Quality classifier (operator 1).

Weak labels: overlapping heuristic labellers vote good, bad or nothing on each
document. Expectation-maximisation over the counts of vote patterns, a table
whose size depends on the number of labellers alone, estimates how often each
labeller is right and gives each pattern its posterior. Posteriors of a bounded
sample then train a linear scorer over hashed word shapes and binned measures,
which scores every document.

Defined cases: a null or empty text has no words, gets no votes and score 0, so
it is rejected; a null id is kept; repeated rows get equal scores; an empty
table gives an empty result; columns besides the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import bounded_sample, documents

#: Documents whose posteriors train the scorer, at most about so many.
MAX_SAMPLE = 20_000
#: Size of the hashed feature space.
DIM = 1 << 12
#: A document goes only if the scorer is fairly sure: 3 to 1.
KEEP_AT = 0.25

GOOD, BAD, NONE = 0, 1, 2
#: Measures of a text with two limits each: a labeller per measure votes bad from
#: the second on; one more, for prose, votes good if no measure is over its first.
MEASURES: dict[str, tuple[float, float]] = {
    "symbols": (0.01, 0.06),
    "capitals": (0.12, 0.5),
    "repeats": (0.15, 0.5),
    "stutter": (0.05, 0.3),
    "marked_words": (0.05, 0.3),
    "bare_signs": (0.02, 0.2),
    "digits": (0.05, 0.25),
    "word_length": (9.0, 14.0),
}
LABELLERS = (*MEASURES, "prose")

_CLASS = np.full(256, ord("a"), np.uint8)  # bytes of letters beyond ASCII count as small letters
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = (ord(" ") if tb.SPACE[_b] else ord("0") if _c.isdigit() else 200 if _c.isupper()
                  else ord("a") if _c.islower() else _b)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "|%&$#*~^=<>{}[]\\@_!+"]] = True
_SIGN = np.array([_CLASS[b] not in (ord(" "), ord("0"), ord("a"), 200) for b in range(256)])
_CAPITAL, _SMALL, _DIGIT = _CLASS == 200, _CLASS == ord("a"), _CLASS == ord("0")


def _per_text(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[offs[1:]] - sums[offs[:-1]]


def measures(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of MEASURES per text, words per text)."""
    h, bounds, starts, ends = tb.word_hashes(data, offs, places=True)
    words = np.diff(bounds)
    solid = np.maximum(_per_text(~tb.SPACE[data], offs), 1)
    small, caps = _per_text(_SMALL[data], offs), _per_text(_CAPITAL[data], offs)
    per_word = np.maximum(words, 1)
    signs = np.concatenate([[0], np.cumsum(_SIGN[data], dtype=np.int64)])
    at_end = signs[ends] - signs[np.maximum(ends - 2, starts)]
    all_signs = signs[ends] - signs[starts] == ends - starts
    rows = np.repeat(np.arange(len(words)), words)
    g, row, _ = tb.grams(h, bounds, 3)
    order = np.lexsort((g, row))
    same = np.zeros(len(g), bool)
    if len(g) > 1:
        same[1:] = (g[order][1:] == g[order][:-1]) & (row[order][1:] == row[order][:-1])
    again = np.bincount(row[order][same], minlength=len(words))
    like = np.flatnonzero((h[1:] == h[:-1]) & (rows[1:] == rows[:-1]))
    out = np.stack([
        _per_text(_SYMBOL[data], offs) / solid,
        caps / np.maximum(small + caps, 1),
        again / np.maximum(words - 2, 1),
        np.bincount(rows[like], minlength=len(words)) / per_word,
        np.bincount(rows, (at_end == 2) & ~all_signs, len(words)) / per_word,
        np.bincount(rows, all_signs, len(words)) / per_word,
        _per_text(_DIGIT[data], offs) / solid,
        solid / per_word,
    ], axis=1)
    return out, words


def votes(m: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One column per labeller; texts without words get no votes."""
    out = np.full((len(m), len(LABELLERS)), NONE, np.int64)
    first, second = np.array(list(MEASURES.values())).T
    out[:, :-1][m >= second] = BAD
    out[(m <= first).all(axis=1), -1] = GOOD
    out[words == 0] = NONE
    return out


def pattern_of(v: np.ndarray) -> np.ndarray:
    return v @ 3 ** np.arange(v.shape[1])


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def fit_labellers(v: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of bad documents, vote probabilities [labeller, class, vote],
    posterior of bad per pattern) by expectation-maximisation.

    The start is the majority of votes, which also fixes which class is which.
    """
    for_bad, for_good = (v == BAD).sum(1), (v == GOOD).sum(1)
    post = (for_bad + 0.5) / (for_bad + for_good + 1.0)
    prior, probs = 0.5, np.zeros((v.shape[1], 2, 3))
    for _ in range(rounds):
        before = post
        weight = np.stack([counts * (1 - post), counts * post])
        prior = float((weight[1].sum() + 1) / (counts.sum() + 2))
        for vote in (GOOD, BAD, NONE):
            probs[:, :, vote] = (weight @ (v == vote) + 0.5).T
        probs /= probs.sum(2, keepdims=True)
        # withholding a vote is an outcome like the others
        ratio = np.log(probs[:, BAD, :]) - np.log(probs[:, GOOD, :])
        z = np.log(prior / (1 - prior)) + ratio[np.arange(v.shape[1]), v].sum(1)
        post = 1 / (1 + np.exp(-z))
        if np.abs(post - before).max() < 1e-6:
            break
    return prior, probs, post


def hashed(data: np.ndarray, offs: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value): shares of word shapes, and binned measures.

    A shape keeps each run of capitals, small letters, digits or one sign once.
    """
    shape = _CLASS[data]
    kept = np.ones(len(shape), bool)
    kept[1:] = shape[1:] != shape[:-1]
    cuts = offs[1:-1]
    kept[cuts[cuts < len(shape)]] = True
    sums = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])
    h, bounds = tb.word_hashes(shape[kept], sums[offs])
    words = np.diff(bounds)
    row = np.repeat(np.arange(len(words)), words)
    key, n = np.unique(row * DIM + (h % np.uint64(DIM)).astype(np.int64), return_counts=True)
    r, f = key // DIM, key % DIM
    shares = m[:, :-1]
    k = shares.shape[1]
    bins = np.minimum((np.sqrt(shares) * 20).astype(np.int64), 20)
    bf = tb.mix((bins + 64 * np.arange(1, k + 1)).astype(np.uint64)) % np.uint64(DIM)
    full = np.flatnonzero(words > 0)
    return (np.concatenate([r, np.repeat(full, k)]),
            np.concatenate([f, bf[full].astype(np.int64).ravel()]),
            np.concatenate([np.sqrt(n / words[r]), np.full(k * len(full), 0.5)]))


def fit_scorer(row: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray,
               rounds: int = 300, rate: float = 2.0, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the last one the constant) of a logistic model for posterior
    targets, by full gradient steps with momentum."""
    w, speed, n = np.zeros(DIM + 1), np.zeros(DIM + 1), max(len(target), 1)
    for _ in range(rounds):
        z = np.bincount(row, value * w[feature], len(target)) + w[DIM]
        miss = (1 / (1 + np.exp(-z)) - target) / n
        grad = np.append(np.bincount(feature, value * miss[row], DIM), miss.sum()) + ridge * w
        speed = 0.9 * speed - rate * grad
        w = w + speed
    return w


def _vote_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(3 ** len(LABELLERS), np.int64)
        for _, data, offs in tb.chunks(batch.column(0)):
            p = pattern_of(votes(*measures(data, offs)))
            total += np.bincount(p, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pattern", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offs in tb.chunks(batch.column(0)):
            m, words = measures(data, offs)
            row, feature, value = hashed(data, offs, m)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(len(words) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pattern_of(votes(m, words))),
                 pa.ListArray.from_arrays(cuts, pa.array(feature[order])),
                 pa.ListArray.from_arrays(cuts, pa.array(value[order]))],
                names=["pattern", "feature", "value"])


def _scores(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, data, offs in tb.chunks(batch.column(1)):
                m, words = measures(data, offs)
                row, feature, value = hashed(data, offs, m)
                z = np.bincount(row, value * weights[feature], len(words)) + weights[DIM]
                score = np.where(words > 0, 1 / (1 + np.exp(z)), 0.0)  # the model is of bad texts
                v = votes(m, words)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(words)), pa.array(score),
                     pa.array((v == GOOD).sum(1)), pa.array((v == BAD).sum(1))],
                    names=["doc_id", "score", "votes_good", "votes_bad"])
    return run


def learn(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> np.ndarray:
    """Weights of the scorer for (doc_id, text): vote patterns of all documents,
    then features of a bounded sample."""
    found = (docs.select("text").mapInArrow(_vote_counts, "pattern long, n long")
             .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect())
    pattern = np.array([r.pattern for r in found], np.int64)
    counts = np.array([r.n for r in found], float)
    none = pattern_of(np.full((1, len(LABELLERS)), NONE))[0]
    counts[pattern == none] = 0.0
    if not counts.sum():
        return np.zeros(DIM + 1)
    _, _, post = fit_labellers(votes_of(pattern), counts)
    posterior = dict(zip(pattern.tolist(), post.tolist()))
    sample = (bounded_sample(docs, "text", max_sample).select("text")
              .mapInArrow(_features, "pattern long, feature array<long>, value array<double>")
              .toArrow())
    pat = sample.column("pattern").to_numpy()
    target = np.array([posterior.get(p, 0.5) for p in pat.tolist()])
    feats, vals = sample.column("feature").combine_chunks(), sample.column("value").combine_chunks()
    row = np.repeat(np.arange(len(pat)), np.diff(feats.offsets.to_numpy()))
    return np.round(fit_scorer(row, feats.flatten().to_numpy(), vals.flatten().to_numpy(), target), 9)


def score_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep_at: float = KEEP_AT, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """doc_id, score (1: good), keep and the votes for every row of ``df``."""
    docs = documents(df, id_col, text_col)
    weights = learn(docs, max_sample)
    return (docs.mapInArrow(_scores(weights), "doc_id long, score double, votes_good long, votes_bad long")
            .select("doc_id", "score", (F.col("score") >= keep_at).cast("int").alias("keep"),
                    "votes_good", "votes_bad"))


def _kept(weights: np.ndarray, text_at: int, keep_at: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores(weights)
        for batch in batches:
            text = batch.column(text_at).fill_null("")
            both = pa.RecordBatch.from_arrays([pa.array(np.arange(len(text))), text], names=["doc_id", "text"])
            for scored in score([both]):
                good = np.flatnonzero(scored.column(1).to_numpy() >= keep_at)
                yield batch.take(scored.column(0).take(pa.array(good)))
    return run


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              keep_at: float = KEEP_AT, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """The rows of ``df`` whose texts score ``keep_at`` or more, in one scan."""
    weights = learn(documents(df, id_col, text_col), max_sample)
    return df.mapInArrow(_kept(weights, df.columns.index(text_col), keep_at), df.schema)
