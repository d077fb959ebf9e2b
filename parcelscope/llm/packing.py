"""Packing into sequences (operator 9).

Bounded-space online packing: each partition keeps a fixed number of open
windows. A document's tokens fill whole windows first; the rest goes to the
open window with the least room that holds it. When none does, the fullest
window is topped up with the beginning of the rest and emitted. What stays open
when a partition ends is merged, a bounded number of partitions at a time; the
last window of such a group is cut into lengths that are powers of two.

Defined cases: a null or empty text is one end token; a null id is kept;
repeated rows are packed each for itself; an empty table packs to no rows;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, documents

SEQUENCE = 4096
OPEN_WINDOWS = 16
#: Partitions whose leftovers are merged together.
MERGED = 32
END_ID = 2
#: Words a worker remembers with their ids.
REMEMBERED = 250_000

# The tokenizer's letters and numbers within Latin-1, and its word pattern.
_LETTERS = "a-zA-Zªµºà-öø-ÿÀ-ÖØ-Þß"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \x85\xa0"
_PRETOKEN = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]"
                       f"|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Ids(dict):
    """Token ids of a text as little-endian unsigned 32-bit numbers.

    Within Latin-1 the tokenizer's own steps (composition, lower case, word
    pattern) work on each word alone, so ids are remembered by word. Other
    texts are cut at spaces and line ends, which the tokenizer drops anyway.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()

    def __missing__(self, word: str) -> bytes:
        letters = self.letters
        got = self.model.tokenize("".join([letters[b] for b in word.encode()]))
        out = b"".join([t.id.to_bytes(4, "little") for t in got])
        if len(word) <= 64:
            self[word] = out
        return out

    def _encoded(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, _PRETOKEN.findall(text.lower())))

    def of(self, text: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        if "<|" in text:  # may hold a special token
            return self._encoded(text)
        if _is_latin(text):
            return self._latin(text)
        return b"".join([self._latin(s) if _is_latin(s) else self._encoded(s)
                         for s in re.split("[ \n]+", text) if s])


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


Piece = tuple  # (doc_id, start, ids as bytes, doc_tokens)


class Window:
    __slots__ = ("room", "pieces")

    def __init__(self) -> None:
        self.room, self.pieces = SEQUENCE, []

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.room -= len(piece[2]) // 4


def _split(piece: Piece, n: int) -> tuple[Piece, Piece]:
    doc, start, ids, total = piece
    return (doc, start, ids[:4 * n], total), (doc, start + n, ids[4 * n:], total)


def place(piece: Piece, windows: list[Window], most: int) -> Iterator[Window]:
    """Put a piece into the open windows; yield those that are full."""
    while len(piece[2]) >= 4 * SEQUENCE:
        head, piece = _split(piece, SEQUENCE)
        full = Window()
        full.put(head)
        yield full
    n = len(piece[2]) // 4
    if not n:
        return
    best = None
    for w in windows:
        if n <= w.room and (best is None or w.room < best.room):
            best = w
    if best is None and len(windows) >= most:
        fullest = min(windows, key=lambda w: w.room)
        head, piece = _split(piece, fullest.room)
        fullest.put(head)
        windows.remove(fullest)
        yield fullest
    if best is None:
        best = Window()
        windows.append(best)
    best.put(piece)
    if not best.room:
        windows.remove(best)
        yield best


SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("ids", pa.binary()), ("part", pa.int64())])
DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
       "sequence_id long, offset long, ids binary, part long")


class Rows:
    """Collects the pieces of sequences as columns."""

    def __init__(self, base: int, part: int):
        self.base, self.part, self.n = base, part, 0
        self.columns: list[list] = [[] for _ in SCHEMA]

    def add(self, pieces: list[Piece], keep_ids: bool = False) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            for col, v in zip(self.columns, (doc, start, n, zlib.crc32(ids), total, self.base + self.n,
                                             at, ids if keep_ids else None, self.part)):
                col.append(v)
            at += n
        self.n += 1

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, SCHEMA)],
                                         schema=SCHEMA)
        self.columns = [[] for _ in SCHEMA]
        return out


def _pack(path: str | None, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(path or tokenizer_path())
        part = TaskContext.get().partitionId()
        rows, windows = Rows(part << 32, part), []
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, doc in enumerate(docs):
                b = ids.of(texts[i].as_py()) + end
                for w in place((doc, 0, b, len(b) // 4), windows, most):
                    rows.add(w.pieces)
                if len(rows.columns[0]) >= 20_000:
                    yield rows.take()
        for w in windows:
            rows.add(w.pieces, keep_ids=True)
        yield rows.take()
    return run


def _merge(key: tuple, found: pa.Table) -> pa.Table:
    """Pour the leftovers of some partitions into whole windows; the last one is
    cut into powers of two, which need no padding."""
    rows = Rows((1 << 62) | (key[0].as_py() << 32), -1)
    found = found.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
    w = Window()
    for doc, start, ids, total in zip(*(found.column(c).to_pylist()
                                        for c in ("doc_id", "start", "ids", "doc_tokens"))):
        piece = (doc, start, ids, total)
        while len(piece[2]) >= 4 * w.room:
            head, piece = _split(piece, w.room)
            w.put(head)
            rows.add(w.pieces)
            w = Window()
        if piece[2]:
            w.put(piece)
    rest, left = w.pieces, SEQUENCE - w.room
    while left:
        size = 1 << (left.bit_length() - 1)
        take, room = [], size
        while room:
            n = min(room, len(rest[0][2]) // 4)
            head, tail = _split(rest[0], n)
            take.append(head)
            rest = ([tail] if tail[2] else []) + rest[1:]
            room -= n
        rows.add(take)
        left -= size
    return pa.Table.from_batches([rows.take()], schema=SCHEMA)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer_file: str | None = None, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer_file`` must be readable by the workers; by default it is the
    installed public word-level vocabulary.
    """
    pieces = cut(documents(df, id_col, text_col).mapInArrow(_pack(tokenizer_file, open_windows), DDL),
                 "packing-pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    merged = (pieces.filter(F.col("ids").isNotNull())
              .groupBy(F.floor(F.col("part") / MERGED).cast("long").alias("grp"))
              .applyInArrow(_merge, DDL))
    return pieces.filter(F.col("ids").isNull()).select(columns).union(merged.select(columns))
