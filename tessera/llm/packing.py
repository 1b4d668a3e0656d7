"""Packing: sum-of-squares online packing of token sequences into fixed windows."""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"
#: Parts of words that a worker remembers the ids of; beyond it the memory starts anew.
CACHE_PARTS = 1_500_000
WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")
#: Words that the tokenizer splits where letters of Latin-1 meet ASCII punctuation: no digit, apostrophe or control string.
LETTERS, PUNCTUATION = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", re.escape("!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")
PLAIN = re.compile(f"[{LETTERS}{PUNCTUATION} \\t\\r\\x0b\\x0c]*")
PARTS = re.compile(f"[{LETTERS}]+|[{PUNCTUATION}]+")


class WordTokens:
    """Ids of a text as little-endian uint32 bytes, by a lower-casing tokenizer that drops white space and never joins words.

    Each distinct part of a word is encoded once by the tokenizer itself: a run of letters or of punctuation of a plain
    word, or any other word as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encode, self.parts = Tokenizer.from_file(path).encode, {}

    def part(self, p: str) -> bytes:
        ids = self.parts.get(p)
        if ids is None:
            if len(self.parts) >= CACHE_PARTS:
                self.parts.clear()
            ids = np.asarray(self.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if len(p) <= 64:
                self.parts[p] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        known, part, out = self.parts.get, self.part, []
        for line in text.split("\n"):
            parts = PARTS.findall(line.lower()) if PLAIN.fullmatch(line) else [p for w in WORD.findall(line) for p in (PARTS.findall(w.lower()) if PLAIN.fullmatch(w) else (w,))]
            out += [known(p) or part(p) for p in parts]
        return b"".join(out)

    @classmethod
    def held(cls, path: str) -> WordTokens:
        """The one of this Python process, which outlives a task."""
        kept = sys.modules.setdefault("_tessera_kept", types.ModuleType("_tessera_kept")).__dict__
        if ("tokens", path) not in kept:
            kept["tokens", path] = cls(path)
        return kept["tokens", path]


class Packer:
    """Sum-of-squares packing into windows of `size` tokens, with a level array of how many open windows have each fill.

    A piece goes to the fill level (or to a new window) after which the sum over levels of the squared counts of partly
    filled windows is least; of equal ones, to the fullest. A document of more than `size` tokens is first cut into
    full windows and a rest. close() joins what is open at the end into full windows by cutting, so that at most one
    window of all is padded.
    """

    def __init__(self, size: int):
        self.size, self.done = size, []
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(size)]  # by fill: windows, each a list of pieces

    def add(self, doc: tuple, ids: bytes) -> None:
        """doc: (doc_id, doc_tokens)."""
        n, w = len(ids) // 4, self.size
        cut = n - n % w
        for at in range(0, cut, w):
            self.done.append([(doc, at, ids[4 * at : 4 * (at + w)])])
        if cut < n:
            self._place((doc, cut, ids[4 * cut :]), n - cut)

    def _place(self, piece: tuple, s: int) -> None:
        w, c = self.size, self.counts
        gain = c[s:] - c[: w - s + 1]  # half the change of the sum of squares, without its constant
        gain[-1] -= 1 if s < w else 0  # a window that becomes full leaves the levels
        free = c[: w - s + 1] > 0
        free[0] = True
        cost = np.where(free, gain, np.iinfo(np.int64).max)
        cost[0] = c[s] - 1  # a new window takes none from a level
        at = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = self.open[at].pop() if at else []
        if at:
            c[at] -= 1
        window.append(piece)
        if at + s == w:
            self.done.append(window)
        else:
            self.open[at + s].append(window)
            c[at + s] += 1

    def close(self) -> None:
        w, window, fill = self.size, [], 0
        for level in range(w - 1, 0, -1):
            for doc, start, ids in (p for x in self.open[level] for p in x):
                while ids:
                    part = ids[: 4 * (w - fill)]
                    window.append((doc, start, part))
                    fill, start, ids = fill + len(part) // 4, start + len(part) // 4, ids[len(part) :]
                    if fill == w:
                        self.done.append(window)
                        window, fill = [], 0
            self.open[level] = []
        self.counts[:] = 0
        if window:
            self.done.append(window)

    def drain(self) -> list[list[tuple]]:
        out, self.done = self.done, []
        return out


def _rows(windows: list[list[tuple]], first: int, size: int) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(8)]
    for k, window in enumerate(windows, first):
        at = 0
        fill = sum(len(ids) for *_, ids in window) // 4
        padded = fill if fill & (fill - 1) == 0 else size
        for (doc_id, tokens), start, ids in window:
            n = len(ids) // 4
            for c, v in zip(cols, (doc_id, start, n, zlib.crc32(ids), tokens, k, at, padded)):
                c.append(v)
            at += n
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document into sequences of at most `window` tokens; one row per piece.

    Each partition is packed by itself in its rows' order and numbers its sequences from (partition << 32), so nothing
    is shuffled and a lost task gives the same rows again. `padded` is the length that the piece's sequence is padded
    to: its fill where that is a power of two, else the window. A null text is empty (only the end id); a null doc_id
    stays null; repeated rows are packed each; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, packer = WordTokens.held(tokenizer), Packer(window)
        number = (TaskContext.get().partitionId() << 32) if TaskContext.get() else 0
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokens(text.as_py() or "") + end
                packer.add((doc_id, len(ids) // 4), ids)
                if len(packer.done) >= 2000:
                    windows = packer.drain()
                    yield _rows(windows, number, window)
                    number += len(windows)
        packer.close()
        yield _rows(packer.drain(), number, window)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
