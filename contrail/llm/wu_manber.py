"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of 13 benchmark words (a shorter item is one pattern). For
all patterns of one length m, a shift table over hashed blocks of two words says
how far the search may jump: a block that ends no nearer than s words before the
end of any pattern allows s, a word foreign to the benchmark allows m. Where the
shift is zero, the bucket of that suffix hash lists the patterns to compare word
by word. Texts are searched in numpy, many stretches of text at a time.

Benchmark words are numbered exactly (a dictionary, not a hash), so a
confirmed pattern is an exact occurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ALNUM_WORDS, filter_rows, id_text, split_words, text_bytes, text_slices

WINDOW = 13
#: Benchmark text searched in one pass; more benchmark takes more passes, never fewer items.
BLOCK_BYTES = 8 << 20
#: Words one search lane covers: long texts are cut into lanes that overlap by a window.
LANE = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split()


class Patterns:
    """Shift tables and suffix buckets of one pattern length."""

    def __init__(self, m: int, windows: np.ndarray, owners: np.ndarray):
        self.m, self.b = m, min(2, m)
        order = np.lexsort((owners, *windows.T[::-1]))
        windows, owners = windows[order], owners[order]
        new = np.r_[True, (windows[1:] != windows[:-1]).any(axis=1)]
        self.windows = windows[new]
        self.owner_at = np.r_[np.flatnonzero(new), len(owners)]
        self.owners = owners
        self.bits = max(10, int(np.ceil(np.log2(8 * len(self.windows) * m + 1))))
        self.shift = np.full(1 << self.bits, m - self.b + 1, np.int32)
        for end in range(self.b - 1, m):
            np.minimum.at(self.shift, self._hash(self.windows, end), m - 1 - end)
        suffix = self._hash(self.windows, m - 1)
        by = np.argsort(suffix, kind="stable")
        self.windows = self.windows[by]
        self.owner_lo, self.owner_hi = self.owner_at[:-1][by], self.owner_at[1:][by]
        self.bucket = np.searchsorted(suffix[by], np.arange((1 << self.bits) + 1))

    def _hash(self, rows: np.ndarray, end: int) -> np.ndarray:
        return self._mix(rows[:, end], rows[:, end - 1] if self.b == 2 else None)

    def _mix(self, last: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        x = last.astype(np.uint64)
        if before is not None:
            x = x * np.uint64(0x2545F4914F6CDD1D) + before.astype(np.uint64)
        return ((x * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, pattern) of every occurrence; texts are ids[offsets[i]:offsets[i+1]]."""
        m, n = self.m, np.diff(offsets)
        lanes = np.maximum(0, -(-(n - m + 1) // LANE))
        text = np.repeat(np.arange(len(n)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = offsets[text] + nth * LANE + m - 1
        stop = np.minimum(pos + LANE, offsets[text + 1])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(pos):
            last = ids[pos]
            before = ids[pos - 1] if self.b == 2 else None
            h = self._mix(last, before)
            step = self.shift[h]
            if before is not None:
                step = np.where(before == 0, m - 1, step)
            step = np.where(last == 0, m, step)
            at = np.flatnonzero(step == 0)
            if len(at):
                lo, hi = self.bucket[h[at]], self.bucket[h[at] + 1]
                k = hi - lo
                which = np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())
                start = np.repeat(pos[at], k) - m + 1
                same = np.ones(len(which), bool)
                for j in range(m):
                    same[same] = ids[start[same] + j] == self.windows[which[same], j]
                if same.any():
                    found.append((start[same], which[same]))
            pos = pos + np.maximum(step, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class Searcher:
    """All patterns of one block of benchmark items."""

    def __init__(self, items: list[tuple[object, bytes]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        by_len: dict[int, tuple[list, list]] = {}
        self.item_ids = [i for i, _ in items]
        for k, (_, text) in enumerate(items):
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            m = min(window, len(ids))
            if m:
                rows, owner = by_len.setdefault(m, ([], []))
                rows.extend(ids[i:i + m] for i in range(len(ids) - m + 1))
                owner.extend([k] * (len(ids) - m + 1))
        self.patterns = [Patterns(m, np.array(r, np.int32), np.array(o, np.int64)) for m, (r, o) in sorted(by_len.items())]

    def search(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[list[str]]]:
        """Words per text, the sorted positions of hit words, and the ids of the items found."""
        words, off = split_words(texts, ALNUM_WORDS)
        n = np.diff(off)
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int32, len(words))
        delta = np.zeros(off[-1] + 1, np.int64)
        pairs = [np.zeros((0, 2), np.int64)]
        for p in self.patterns:
            start, which = p.search(ids, off)
            np.add.at(delta, start, 1)
            np.add.at(delta, start + p.m, -1)
            lo, k = p.owner_lo[which], p.owner_hi[which] - p.owner_lo[which]
            owner = p.owners[np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())]
            pairs.append(np.unique(np.c_[np.repeat(np.searchsorted(off, start, side="right") - 1, k), owner], axis=0))
        hit = np.flatnonzero(np.cumsum(delta[:-1]) > 0)
        text = np.searchsorted(off, hit, side="right") - 1
        cut = np.searchsorted(text, np.arange(len(texts) + 1))
        items: list[list[str]] = [[] for _ in texts]
        for t, owner in np.unique(np.concatenate(pairs), axis=0).tolist():
            if self.item_ids[owner] is not None:
                items[t].append(self.item_ids[owner])
        return n, [hit[cut[i]:cut[i + 1]] - off[i] for i in range(len(texts))], items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark in blocks of bounded size; the driver holds one block at a time."""
    items, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    for item, text in rows.toLocalIterator(prefetchPartitions=False):
        raw = (text or "").encode()
        if items and size + len(raw) > BLOCK_BYTES:
            yield items
            items, size = [], 0
        items.append((item, raw))
        size += len(raw)
    yield items


def _searchers(benchmark: DataFrame, window: int, item_col: str) -> list:
    """A broadcast searcher for each block of the benchmark."""
    sc = benchmark.sparkSession.sparkContext
    return [sc.broadcast(Searcher(block, window)) for block in _blocks(benchmark, item_col, "text")]


def _search_all(searchers: list, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[list[str]]]:
    """Words, hit positions and sorted item ids of each text over all blocks."""
    n, hits, items = searchers[0].value.search(texts)
    for more in searchers[1:]:
        _, h, i = more.value.search(texts)
        hits, items = list(map(np.union1d, hits, h)), [a + b for a, b in zip(items, i, strict=True)]
    return n, hits, [sorted(set(i)) for i in items]


def _contaminated(n: np.ndarray, hits: list[np.ndarray]) -> np.ndarray:
    k = np.fromiter(map(len, hits), np.int64, len(hits))
    return (k > 0) & (20 * k >= n)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    A document word is hit when it lies inside any occurrence of a window of any
    item; a document is contaminated when at least a twentieth of its words are
    hit. Null or wordless texts have no words and are clean; null or wordless
    items match nothing; an item without an id hits words like any other, but is not named or counted; items with equal texts are all reported; a repeated item
    id counts once. Repeated rows give a row each, and an empty benchmark hits
    nothing. ``items`` lists the item ids as sorted strings. No shuffle: every
    slice of texts is searched by each benchmark block in turn.
    """
    searchers = _searchers(benchmark, window, item_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            n, hits, items = _search_all(searchers, text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(list(map(len, hits)), pa.int64()),
                 pa.array(_contaminated(n, hits)), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "n_words", "n_hit", "contaminated", "items"])

    found = id_text(docs).mapInArrow(run, "doc_id long, n_words long, n_hit long, contaminated boolean, items array<string>")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated", "items",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs``, all columns, that ``decontaminate`` calls clean."""
    searchers = _searchers(benchmark, window, item_col)

    def keep(part: pa.RecordBatch) -> np.ndarray:
        n, hits, _ = _search_all(searchers, text_bytes(part.column("text")))
        return ~_contaminated(n, hits)

    return filter_rows(docs, keep)
