"""Suffix sorting by induction with spilling queues, and with common-prefix lengths.

Suffixes are sorted by recursive induced sorting: the suffixes that start at a
left-most smaller symbol are named by their substrings and sorted recursively
where names repeat, then all other suffixes are induced from them in two scans.
The scans read from a priority queue over symbols. Entries for symbols far
from the scan wait in buffers that spill to disk. Symbols, names and the result of
the recursion are in memory, so the caller bounds the text. Every entry carries its suffix and the length of its
common prefix with its neighbour, and an induced neighbour's length follows from
the smallest length scanned in between.
"""

from __future__ import annotations

import heapq
import tempfile
from array import array
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np

#: Entries of one stretch of symbols, and numbers buffered before they spill.
STRETCH, BUFFER = 1 << 19, 1 << 21


class SpillQueue:
    """Entries (symbol, suffix, prefix) in order of arrival, by stretch of symbols.

    What does not fit the buffer goes to a file without a name, which ends with the task.
    """

    def __init__(self, stretches: int, buffer: int = BUFFER):
        self.held = [array("q") for _ in range(stretches)]
        self.where: list[list[tuple[int, int]]] = [[] for _ in range(stretches)]
        self.room = self.buffer = buffer
        self.file = None

    def push(self, stretch: int, symbol: int, suffix: int, prefix: int) -> None:
        self.held[stretch].extend((symbol, suffix, prefix))
        self.room -= 3
        if self.room < 0:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115
        at = self.file.seek(0, 2)
        for i, held in enumerate(self.held):
            if held:
                held.tofile(self.file)
                self.where[i].append((at, len(held)))
                at += 8 * len(held)
                self.held[i] = array("q")
        self.room = self.buffer

    def take(self, stretch: int) -> Iterator[tuple[int, int, int]]:
        """The entries of a stretch in order of arrival; they are gone afterwards."""
        got = array("q")
        for at, n in self.where[stretch]:
            self.file.seek(at)
            got.fromfile(self.file, n)
        self.where[stretch] = []
        got.extend(self.held[stretch])
        self.room += len(self.held[stretch])
        self.held[stretch] = array("q")
        it = iter(got)
        return zip(it, it, it, strict=True)


class _Prefixes:
    """Smallest common prefix scanned since an earlier moment."""

    def __init__(self):
        self.now, self.times, self.least = 0, [], []
        self.last: dict[int, int] = {}

    def scanned(self, prefix: int) -> None:
        self.now += 1
        while self.least and self.least[-1] >= prefix:
            self.least.pop()
            self.times.pop()
        self.least.append(prefix)
        self.times.append(self.now)

    def induced(self, symbol: int) -> int:
        """Common prefix of a suffix induced now with the one induced before it for the same symbol."""
        before = self.last.get(symbol)
        self.last[symbol] = self.now
        return 0 if before is None else 1 + self.least[bisect_right(self.times, before)]


class _Text:
    """A text whose last symbol, 0, is its smallest and stands nowhere else."""

    def __init__(self, symbols: np.ndarray, stretch: int, buffer: int):
        n = len(symbols)
        step = np.sign(symbols[1:].astype(np.int64) - symbols[:-1])
        # equal neighbours take the type of what follows them
        known = np.flatnonzero(step)
        kind = np.zeros(n, bool)  # smaller than the next suffix
        kind[n - 1] = True
        if len(known):
            nxt = np.searchsorted(known, np.arange(n - 1))
            kind[:-1] = step[known[np.minimum(nxt, len(known) - 1)]] > 0
        self.n, self.buffer, self.stretch = n, buffer, stretch
        self.symbols = symbols.tolist()
        self.small = kind.tolist()
        self.stars = (np.flatnonzero(kind[1:] & ~kind[:-1]) + 1).tolist()
        ends = np.flatnonzero(np.r_[symbols[1:] != symbols[:-1], True])
        self.repeats = (ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1).tolist()
        counts = np.bincount(symbols)
        self.part = ((np.cumsum(counts) - counts) // stretch).tolist()  # stretch of each symbol
        self.parts = self.part[-1] + 1

    def queue(self) -> SpillQueue:
        return SpillQueue(self.parts, self.buffer)

    def _upwards(self, seeds: SpillQueue) -> SpillQueue:
        """The suffixes larger than their next one, in rising order, induced from the sorted stars."""
        symbols, is_small, part = self.symbols, self.small, self.part
        queue, large, prefixes = self.queue(), self.queue(), _Prefixes()
        for here in range(self.parts):
            due: dict[int, list] = {}
            stars: dict[int, list] = {}
            for s, p, c in queue.take(here):
                due.setdefault(s, []).append((p, c))
            for s, p, c in seeds.take(here):
                stars.setdefault(s, []).append((p, c))
            order = list(due.keys() | stars.keys())
            heapq.heapify(order)
            while order:
                symbol = heapq.heappop(order)
                items = due.setdefault(symbol, [])
                # a suffix induced for the symbol being scanned joins the list while it is read
                for p, common in _chained(items, stars.pop(symbol, ()), self.repeats):
                    prefixes.scanned(common)
                    q = p - 1
                    if q >= 0 and not is_small[q]:
                        s = symbols[q]
                        common = prefixes.induced(s)
                        if part[s] != here:
                            queue.push(part[s], s, q, common)
                            continue
                        if s not in due and s not in stars:
                            heapq.heappush(order, s)
                        due.setdefault(s, []).append((q, common))
                for p, common in items:
                    large.push(here, symbol, p, common)
                del due[symbol]
        return large

    def induce(self, stars: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """All suffixes but the last, largest first, each with the length it shares with the one before it.

        ``stars`` are the sorted suffixes at stars, each with the length shared with the one before.
        """
        symbols, is_small, part = self.symbols, self.small, self.part
        seeds = self.queue()
        for p, c in stars:
            seeds.push(part[symbols[p]], symbols[p], p, c)
        large = self._upwards(seeds)
        queue, prefixes = self.queue(), _Prefixes()
        for here in range(self.parts - 1, -1, -1):
            due: dict[int, list] = {}
            down: dict[int, list] = {}
            for s, p, c in queue.take(here):
                due.setdefault(s, []).append((p, c))
            for s, p, c in large.take(here):
                down.setdefault(s, []).append((p, c))
            order = [-s for s in due.keys() | down.keys()]
            heapq.heapify(order)
            while order:
                symbol = -heapq.heappop(order)
                items = due.setdefault(symbol, [])
                for p, common in _chained(items, _falling(down.pop(symbol, ())), self.repeats):
                    prefixes.scanned(common)
                    yield p, common
                    q = p - 1
                    if q >= 0 and is_small[q]:
                        s = symbols[q]
                        common = prefixes.induced(s)
                        if part[s] != here:
                            queue.push(part[s], s, q, common)
                            continue
                        if s not in due and s not in down:
                            heapq.heappush(order, -s)
                        due.setdefault(s, []).append((q, common))
                del due[symbol]


def _chained(first: list, then: Sequence[tuple[int, int]], repeats: list[int]) -> Iterator[tuple[int, int]]:
    """Both lists of one symbol in turn; where they meet, the suffixes share the run of that symbol."""
    yield from first
    last = first[-1][0] if first else None
    for p, common in then:
        if last is not None:
            common, last = min(repeats[last], repeats[p]), None
        yield p, common


def _falling(rising: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """A rising list turned round: each length then belongs to the entry after it."""
    return [(p, rising[i + 1][1] if i + 1 < len(rising) else 0) for i, (p, _) in reversed(list(enumerate(rising)))]


def suffixes(symbols: np.ndarray, stretch: int = STRETCH, buffer: int = BUFFER) -> Iterator[tuple[int, int]]:
    """(suffix, length shared with the one before it) of all suffixes, largest first.

    ``symbols`` are numbers from 1; the shorter of two suffixes with a common prefix is the smaller.
    """
    if not len(symbols):
        return iter(())
    return _sorted(np.r_[symbols, 0], stretch, buffer)


def _sorted(symbols: np.ndarray, stretch: int, buffer: int) -> Iterator[tuple[int, int]]:
    text = _Text(symbols, stretch, buffer)
    return text.induce(_sorted_stars(text, stretch, buffer))


def _sorted_stars(text: _Text, stretch: int, buffer: int) -> Iterator[tuple[int, int]]:
    """The suffixes at stars in rising order, with the length shared with the one before."""
    stars, symbols = text.stars, text.symbols
    if not stars:
        return
    ends = {p: e + 1 for p, e in zip(stars, [*stars[1:], text.n - 1], strict=True)}
    # one round of induction sorts the substrings between stars, whatever the order of equal ones
    is_star = set(stars)
    falling = [p for p, _ in text.induce(iter([(p, 0) for p in stars])) if p in is_star]
    if falling[-1:] != [text.n - 1] and text.n - 1 in is_star:
        falling.append(text.n - 1)
    rising = falling[::-1]
    name, names, before = 0, {}, None
    for p in rising:
        part = symbols[p:ends[p]]
        name += part != before
        names[p], before = name, part
    if name == len(stars):
        ranks = ((p, 0) for p in rising)
    else:
        # the last star is the end of the text, whose name is the smallest and unique
        reduced = np.array([names[p] for p in stars], np.int64) - 1
        below = list(_sorted(reduced, stretch, buffer))
        below.append((len(stars) - 1, 0))
        ranks = ((stars[p], c) for p, c in _falling([*below]))
    at = {p: i for i, p in enumerate(stars)}
    before = None
    for p, equal in ranks:
        common = 0
        if before is not None:
            # equal names first, then symbol by symbol inside the first pair of differing substrings
            i = at[p] + equal
            common = stars[i] - p if i < len(stars) else text.n - p
            while symbols[p + common] == symbols[before + common]:
                common += 1
        yield p, common
        before = p
