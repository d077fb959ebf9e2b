"""Benchmark decontamination (operator 10).

Word n-grams of the test items are counted over all documents. An n-gram is common
for an item when many documents hold it without another n-gram of that item next to
it; so copies of the item, edited ones included, don't make its n-grams common,
however many they are. All n-grams of an item but the common ones are its rare
seeds, and at least the rarer half. A passage that holds a rare seed is aligned with
the item by Smith-Waterman, many pairs at a time, and the score is the share of a
perfect alignment. A passage that holds common n-grams only is aligned too, unless a
bound on its score (:func:`bound`) rules it out. So rarity decides how much work a
passage is, never what is found: every copy with one n-gram whole is aligned.

The items are worked on in blocks of bounded size; each block's n-grams go to
the workers with the function that scans the documents.

Defined cases: null texts count as empty; items of fewer than ``N`` words have
no n-gram and match nothing; equal n-grams of several items are seeds of each;
repeated items and rows are each reported for themselves, once per pair of
rows' ids; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import documents

N = 3
#: Share of an item's n-grams, from the rarest, that are rare seeds anyhow; and their least number.
SEED_SHARE, LEAST_SEEDS = 0.5, 6
#: An n-gram that stands alone in so few documents, or in so small a share of them, is always a rare seed.
RARE_TEXTS, RARE_SHARE = 20, 5e-5
#: Alignment: points for a match, a mismatch and a gap.
MATCH, MISMATCH, GAP = 2, -1, -1
FOUND_AT = 0.5
#: Words of items in a block (8 bytes each on every worker).
BLOCK_WORDS = 1_000_000
_FILTER = 1 << 22
#: Pairs worked on together, and words of their windows.
_PAIRS, _CELLS = 512, 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Items:
    """Words and n-grams of a block of items."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        words, bounds = [], [0]
        for _, data, offs in tb.chunks(pa.array(texts, pa.string())):
            h, b = tb.word_hashes(data, offs, tb.NOT_ALNUM)
            words.append(h)
            bounds.extend((b[1:] + bounds[-1]).tolist())
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.bounds = np.array(bounds)
        g, self.item, where = tb.grams(self.words, self.bounds, N)
        order = np.argsort(g, kind="stable")
        self.gram, self.item = g[order], self.item[order]
        self.place = (where - self.bounds[:-1][self.item[np.argsort(order)]])[order] if len(g) else where
        self.unique, self.first = np.unique(self.gram, return_index=True)
        self.last = np.append(self.first[1:], len(self.gram))

    def rare(self, df: np.ndarray, texts: int) -> np.ndarray:
        """Which n-grams of each item aren't common, or are among its rarer ones with those
        tied at the edge, from the documents that hold each without its neighbours."""
        order = np.lexsort((df, self.item))
        size = np.bincount(self.item, minlength=len(self.ids))
        start = np.cumsum(size) - size
        edge = np.minimum(np.maximum(np.ceil(SEED_SHARE * size), LEAST_SEEDS), size).astype(np.int64) - 1
        full = size > 0
        most = np.zeros(len(size), np.int64)
        most[full] = df[order][(start + edge)[full]]
        return df <= np.maximum(most[self.item], RARE_TEXTS + RARE_SHARE * texts)

    def own_words(self) -> np.ndarray:
        """Sorted keys of the (item, word) pairs."""
        return np.unique(_pair(np.repeat(np.arange(len(self.ids)), np.diff(self.bounds)), self.words))


def _pair(item: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (word ^ (item.astype(np.uint64) + np.uint64(1)) * _MIX) * _MIX


def _in(sorted_grams: np.ndarray):
    """A test for membership that looks most others up in a small table only."""
    table = np.zeros(_FILTER, bool)
    table[(sorted_grams % np.uint64(_FILTER)).astype(np.int64)] = True

    def find(g: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(table[(g % np.uint64(_FILTER)).astype(np.int64)])
        if not len(at) or not len(sorted_grams):
            return at[:0]
        pos = np.minimum(np.searchsorted(sorted_grams, g[at]), len(sorted_grams) - 1)
        return at[sorted_grams[pos] == g[at]]
    return find


def _passages(seeds: Items, at: np.ndarray, g, row, where, bounds):
    """Hits on n-grams of items, sorted by row, item and passage: (row, item, first
    word, last word + 1, entry of the n-gram, starts of the passages). Hits on about
    the same diagonal are one passage."""
    lo, hi = np.searchsorted(seeds.gram, g[at]), np.searchsorted(seeds.gram, g[at], "right")
    n = hi - lo
    k = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    at = np.repeat(at, n)
    item, r = seeds.item[k], row[at]
    size = (seeds.bounds[1:] - seeds.bounds[:-1])[item]
    slack = size // 4 + 4
    a = np.maximum(where[at] - seeds.place[k] - slack, bounds[r])
    b = np.minimum(where[at] - seeds.place[k] + size + slack, bounds[r + 1])
    order = np.lexsort((a, item, r))
    r, item, a, b, k = r[order], item[order], a[order], b[order], k[order]
    far = np.ones(len(r), bool)
    far[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (a[1:] - a[:-1] > slack[order][1:] // 2)
    # a long chain of hits is cut, so a window is at most some three times as long as its item
    start = np.flatnonzero(far)
    part = (a - np.repeat(a[start], np.diff(np.append(start, len(r))))) // np.maximum(size[order], 1)
    far[1:] |= part[1:] != part[:-1]
    return r, item, a, b, k, np.flatnonzero(far)


def _steps(order: np.ndarray, width: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """``order`` in pieces of at most ``most`` windows and about ``_CELLS`` words."""
    i = 0
    while i < len(order):
        n = min(max(_CELLS // int(width[order[i:i + most]].max(initial=1) or 1), 1), most)
        yield order[i:i + n]
        i += n


def _count(items: Items):
    """mapInArrow body: for each n-gram of each item, the texts that hold it in a
    passage without another n-gram of the item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, size = _in(items.unique), max(len(items.gram), 1)
        for batch in batches:
            total = np.zeros(len(items.gram), np.int64)
            for _, data, offs in tb.chunks(batch.column(0)):
                h, bounds = tb.word_hashes(data, offs, tb.NOT_ALNUM)
                g, row, where = tb.grams(h, bounds, N)
                r, _, _, _, k, start = _passages(items, find(g), g, row, where, bounds)
                if not len(r):
                    continue
                gram = items.gram[k]
                alone = np.repeat(np.minimum.reduceat(gram, start) == np.maximum.reduceat(gram, start),
                                  np.diff(np.append(start, len(r))))
                pair = np.unique(r[alone] * size + k[alone])
                total += np.bincount(pair % size, minlength=len(total))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["k", "n"])
    return run


def align(items: np.ndarray, lengths: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best local alignment of each row of ``items`` (padded with 0) with its row
    of ``windows`` (padded with 1), as a share of a perfect one.

    All pairs advance together, one item word at a time. Gaps along the window
    are a running maximum of the row plus the gap's price per place.
    """
    width = windows.shape[1]
    slope = -GAP * np.arange(width + 1)
    row = np.zeros((len(items), width + 1), np.int32)
    best = np.zeros(len(items), np.int32)
    for i in range(items.shape[1]):
        hit = np.where(windows == items[:, i:i + 1], MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + hit)
        new = np.maximum.accumulate(new + slope, axis=1) - slope
        live = i < lengths
        row = np.where(live[:, None], new, row)
        best = np.maximum(best, row.max(axis=1))
    return best / (MATCH * np.maximum(lengths, 1))


def bound(inside: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The most that :func:`align` can give for windows whose words are or aren't among
    their item's (``inside``): a word of the aligned stretch that the item lacks is a
    mismatch or a gap, any other a match at best, so no stretch scores more than the
    dearest run of these prices. Equal keys of different pairs only raise it."""
    total = np.cumsum(np.where(inside, MATCH, max(MISMATCH, GAP)), axis=1, dtype=np.int32)
    low = np.minimum(np.minimum.accumulate(total, axis=1), 0)
    before = np.concatenate([np.zeros((len(total), 1), np.int32), low[:, :-1]], axis=1)
    return (total - before).max(axis=1, initial=0) / (MATCH * np.maximum(lengths, 1))


def _possible(items: Items, h, item, a, b, size, has_word, found_at: float) -> np.ndarray:
    """Which passages can reach ``found_at``."""
    out = np.zeros(len(item), bool)
    for k in _steps(np.argsort(b - a, kind="stable"), b - a, 8 * _PAIRS):
        windows = _rows(h, a[k], b[k] - a[k], 0)
        inside = np.zeros(windows.size, bool)
        inside[has_word(_pair(item[k][:, None], windows).ravel())] = True
        inside = inside.reshape(windows.shape) & (np.arange(windows.shape[1]) < (b[k] - a[k])[:, None])
        out[k] = bound(inside, size[k]) >= found_at
    return out


def _search(items: Items, rare: np.ndarray, found_at: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, has_word = _in(items.unique), _in(items.own_words())
        for batch in batches:
            for at, data, offs in tb.chunks(batch.column(1)):
                h, bounds = tb.word_hashes(data, offs, tb.NOT_ALNUM)
                g, row, where = tb.grams(h, bounds, N)
                r, item, a, b, entry, start = _passages(items, find(g), g, row, where, bounds)
                if not len(r):
                    continue
                r, item, a, b, seeded = (r[start], item[start], a[start], np.maximum.reduceat(b, start),
                                         np.logical_or.reduceat(rare[entry], start))
                size = (items.bounds[1:] - items.bounds[:-1])[item]
                weak = np.flatnonzero(~seeded)
                seeded[weak] = _possible(items, h, item[weak], a[weak], b[weak], size[weak], has_word, found_at)
                r, item, a, b, size = r[seeded], item[seeded], a[seeded], b[seeded], size[seeded]
                score = np.zeros(len(r))
                for k in _steps(np.lexsort((b - a, size)), b - a, _PAIRS):
                    score[k] = align(_rows(items.words, items.bounds[item[k]], size[k], 0), size[k],
                                     _rows(h, a[k], b[k] - a[k], 1))
                ok = np.flatnonzero(score >= found_at)
                # the best passage of each pair, the first of equals
                ok = ok[np.lexsort((a[ok], -score[ok], item[ok], r[ok]))]
                new = np.ones(len(ok), bool)
                new[1:] = (r[ok][1:] != r[ok][:-1]) | (item[ok][1:] != item[ok][:-1])
                ok = ok[new]
                own = batch.column(0).take(pa.array(at + r[ok]))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array([items.ids[i] for i in item[ok]], pa.int64()), pa.array(score[ok]),
                     pa.array(a[ok] - bounds[r[ok]]), pa.array(b[ok] - bounds[r[ok]])],
                    names=["doc_id", "item_id", "score", "first_word", "end_word"])
    return run


def _rows(words: np.ndarray, start: np.ndarray, size: np.ndarray, pad: int) -> np.ndarray:
    width = int(size.max()) if len(size) else 0
    k = np.arange(width)
    at = np.minimum(start[:, None] + k, max(len(words) - 1, 0))
    return np.where(k < size[:, None], words[at], np.uint64(pad))


RESULT = "doc_id long, item_id long, score double, first_word long, end_word long"


def blocks(benchmark: DataFrame, id_col: str, text_col: str, words: int = BLOCK_WORDS) -> Iterator[Items]:
    ids, texts, size = [], [], 0
    for r in documents(benchmark, id_col, text_col).orderBy("doc_id", "text").toLocalIterator():
        ids.append(r.doc_id)
        texts.append(r.text)
        size += len(r.text) // 4 + 1
        if size >= words:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text",
                 found_at: float = FOUND_AT) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word of every document that holds an item."""
    docs = documents(df, id_col, text_col)
    out, n = None, docs.count()
    for items in blocks(benchmark, item_id_col, item_text_col):
        counts = (docs.select("text").mapInArrow(_count(items), "k long, n long")
                  .groupBy("k").agg(F.sum("n").alias("n")).collect())
        texts_with = np.zeros(len(items.gram), np.int64)
        for r in counts:
            texts_with[r.k] = r.n
        part = docs.mapInArrow(_search(items, items.rare(texts_with, n), found_at), RESULT)
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], RESULT)
    # rows of one id: its best passage
    best = F.max_by(F.struct("score", "first_word", "end_word"),
                    F.struct("score", -F.col("first_word"), "end_word"))
    return (out.groupBy("doc_id", "item_id").agg(best.alias("m"))
            .select("doc_id", "item_id", "m.score", "m.first_word", "m.end_word"))
