"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

A word is reached in three choices, class, class within it and word, each a
softmax over sums of hashed n-gram and skip features of the history:
P(word | history) is their product. Half of the classes hold the frequent words,
by frequency. All other words are dealt to the leaves of the other half by a hash,
so that the history bears on them too; within such a leaf a word keeps its add-one
unigram share. The probabilities of all words and of one unseen word in each of
those leaves add up to 1. Leaves and feature rows grow with the counted vocabulary.

Training is synchronous: documents are dealt to ROUNDS rounds by a hash of the
row, and in each round Spark adds up one gradient over all its documents. The
gradient is what was seen minus what is drawn from the model's own softmax, one
draw for each choice by a hash of the token's place, so its parts are whole
numbers: their sum, and so every score, is the same on any number of cores, tasks
and files. Word counts cover all training documents. For scoring, documents are
taken in blocks of rows; a block meets the counts of its own distinct words in a
cogroup, so the vocabulary is never held, collected or broadcast as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ASCII_LOWER_WORDS, fold_of, located, split_words, stored, text_bytes, text_slices, word_array  # noqa: F401

#: Rounds of training, its step, and the counts that damp a rare row's step.
ROUNDS, STEP, DAMP = 6, 1 / 1.5, 4.0
#: Text of a task in a round, at least (while cores are free) and at most; tasks whose sums one task adds up.
TASK_BYTES, LANE = (8 << 20, 64 << 20), 64
#: Tokens taken at a time, rows of the weight table that travel together, text bytes hashed at a time.
BATCH, PIECE, HASH_BYTES = 8192, 4096, 1 << 20
#: Distinct words up to which the model has its least shape; past it weights and leaves grow with the square root.
LEAST_SHAPE_WORDS = 400_000
#: The weight table is broadcast, so it stops growing here; leaves don't.
MOST_WEIGHT_BYTES = 512 << 20
#: Log weight of a branch that no word is in, and the most a weight may be: four of them can be put to the exponent.
SHUT, MOST = -60.0, 20.0
#: Text of a scoring block, and distinct words a counting task holds before it passes them on.
BLOCK_BYTES, FLUSH = 16 << 20, 300_000
#: The end of a text as a token: no word is empty.
END = b""
_BEGIN = 0x51ED270B
_U32, _U64 = np.uint32, np.uint64


def learns_from(col: Column) -> Column:
    """Rows the model may learn from: crc32 of the id as text, modulo 7, is not 2."""
    return F.coalesce(fold_of(col, 7) != 2, F.lit(True))


@dataclass(frozen=True)
class Shape:
    """Branches of each choice, and rows of the weight table."""

    fan: int = 16
    rows: int = 1 << 18

    @property
    def named(self) -> int:
        """Leaves of one word each."""
        return self.fan // 2 * self.fan ** 2

    @property
    def tails(self) -> int:
        """Leaves shared by all other words."""
        return self.fan ** 3 - self.named

    @property
    def nodes(self) -> int:
        return 1 + self.fan + self.fan ** 2

    @staticmethod
    def of(v: int) -> Shape:
        """The shape for ``v`` distinct words; leaves and weights grow with the square root of ``v``."""
        g = max(1.0, v / LEAST_SHAPE_WORDS) ** (1 / 6)
        fan = math.ceil(16 * g)
        rows = min(math.ceil(64 * g ** 2), MOST_WEIGHT_BYTES // (4 * fan * PIECE)) * PIECE
        return Shape(fan, rows)


@dataclass
class Vocabulary:
    """The frequent words by rank, the size of what is left, and the mass of each shared leaf."""

    head: dict[bytes, int]
    n: int        # training tokens
    v: int        # distinct training tokens
    shape: Shape
    tail_mass: np.ndarray  # of each shared leaf: its words' counts, each plus one, and one unseen word
    _index: tuple | None = field(default=None, repr=False)

    def leaves(self, h: np.ndarray) -> np.ndarray:
        """The leaf of each word hash."""
        if self._index is None:
            words = list(self.head)
            mine = hashes_of(words)
            order = np.argsort(mine)
            bits = max(1, len(words)).bit_length() + 5
            keys = mine[order]
            begin = np.searchsorted(keys, np.arange(1 << bits).astype(_U64) << _U64(64 - bits))
            most = int(np.diff(np.r_[begin, len(keys)]).max(initial=0))
            ranks = np.array([self.head[w] for w in words], np.int64)[order]
            pad = np.zeros(most + 1, np.int64)
            self._index = bits, begin, most, np.r_[keys, pad.astype(_U64)], np.r_[ranks, pad - 1]
        bits, begin, most, keys, ranks = self._index
        out = self.shape.named + (h % _U64(self.shape.tails)).astype(np.int64)
        at = begin[h >> _U64(64 - bits)]
        for j in range(most):
            same = (keys[at + j] == h) & (ranks[at + j] >= 0)
            out[same] = ranks[at[same] + j]
        return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the offset of each text in them; no word is made an object."""
    if not texts:
        return np.zeros(0, _U64), np.zeros(1, np.int64)
    data = np.frombuffer(b" ".join([*texts, b""]).translate(ASCII_LOWER_WORDS), np.uint8)
    word = np.r_[False, data != 32, False]
    edges = np.flatnonzero(word[1:] != word[:-1])
    first, last = edges[::2], edges[1::2]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    out = np.empty(len(first), _U64)
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(last, first[i] + HASH_BYTES, side="right")))
        size = last[i:j] - first[i:j]
        at = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(at, size)
        power = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, _U64))
        out[i:j] = np.add.reduceat((data[np.repeat(first[i:j], size) + inside].astype(_U64) + _U64(1)) * power[inside], at)
        i = j
    out ^= out >> _U64(29)
    out *= _U64(0xBF58476D1CE4E5B9)
    return out ^ (out >> _U64(32)), np.searchsorted(first, begins)


class Tokens:
    """Token arrays of some texts: leaf, hashes of the word and of the two before it, and place in the text."""

    def __init__(self, texts: list[bytes], vocab: Vocabulary):
        words, off = word_hashes(texts)
        self.lengths = np.diff(off) + 1
        self.ends = np.cumsum(self.lengths) - 1
        self.inside = np.ones(len(words) + len(texts), bool)
        self.inside[self.ends] = False
        h = np.zeros(len(self.inside), _U64)
        h[self.inside] = words
        self.leaf = vocab.leaves(h)
        self.hash = (h >> _U64(32)).astype(_U32)
        self.place = np.arange(len(h)) - np.repeat(self.ends - self.lengths + 1, self.lengths)
        self.before, self.skipped = self._back(1), self._back(2)

    def _back(self, k: int) -> np.ndarray:
        out = np.full(len(self.hash), _BEGIN, _U32)
        if k < len(out):
            out[k:] = np.where(self.place[k:] >= k, self.hash[:-k], _U32(_BEGIN))
        return out


def _mix(*parts: np.ndarray | int) -> np.ndarray:
    x = np.zeros(1, _U32)
    for p in parts:
        x = (x ^ np.asarray(p).astype(_U32)) * _U32(0x9E3779B1)
        x = x ^ (x >> _U32(15))
    return x


def choices(t: Tokens, shape: Shape, part: slice) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """For each of a token's three choices the rows of the weight table that bear on it, and the branch taken.

    The node has a row of its own. Hashed with it go the previous word, the previous two and, past it, the word
    before; the pair is left out of the last choice and the skip out of the second, where they tell little.
    """
    fan, leaf = shape.fan, t.leaf[part]
    a, b = t.before[part], t.skipped[part]
    one, two, skip = _mix(1, a), _mix(2, a, b), _mix(3, b)
    nodes = np.zeros(len(leaf), np.int64), 1 + leaf // fan ** 2, 1 + fan + leaf // fan
    taken = leaf // fan ** 2, leaf // fan % fan, leaf % fan
    for node, branch, features in zip(nodes, taken, ((one, two, skip), (one, two), (one, skip)), strict=True):
        own = node.astype(_U32) * _U32(0x9E3779B1)
        rows = [node]
        for f in features:
            x = (f ^ own) * _U32(0x85EBCA77)
            x = (x ^ (x >> _U32(15))) * _U32(0x9E3779B1)
            rows.append(shape.nodes + ((x.astype(_U64) * _U64(shape.rows - shape.nodes)) >> _U64(32)).astype(np.int64))
        yield rows, branch


def _logits(table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    # all rows are in the table: with "clip" numpy copies them straight to where they go
    x, more = (np.empty((len(rows[0]), table.shape[1]), table.dtype) for _ in range(2))
    table.take(rows[0], axis=0, out=x, mode="clip")
    for r in rows[1:]:
        x += table.take(r, axis=0, out=more, mode="clip")
    return x


def _sums(table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Running sums over the branches, one to a row, of their unscaled probabilities; the last row is the whole."""
    x = np.ascontiguousarray(_logits(table, rows).T)
    np.exp(x, out=x)
    for j in range(1, len(x)):  # faster than cumsum along short rows
        x[j] += x[j - 1]
    return x


def _drawn(sums: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The first branch whose running sum reaches the share ``u`` of the whole; u is at most 1, so the last one does."""
    at = u * sums[-1]
    out = np.zeros(len(u), np.int16)
    for row in sums[:-1]:
        out += (row < at).view(np.int8)
    return out.astype(np.int64)


class Gradient:
    """What a round's tokens took and what was drawn from the model, for each weight."""

    def __init__(self, table: np.ndarray, shape: Shape):
        self.table, self.shape = table, shape
        self.seen, self.drawn = np.zeros(table.size, np.int32), np.zeros(table.size, np.int32)

    def add(self, t: Tokens, ids: np.ndarray) -> None:
        """``ids`` of the texts set equal texts' draws apart."""
        one, fan = np.int32(1), self.shape.fan
        salt = np.repeat(_mix(ids, ids >> 32), t.lengths)
        for at in range(0, len(t.leaf), BATCH):
            part = slice(at, at + BATCH)
            seed = _mix(7, salt[part], t.place[part], t.hash[part])
            for level, (rows, branch) in enumerate(choices(t, self.shape, part)):
                sums = _sums(self.table, rows)
                u = (_mix(level, seed).astype(np.float32) + np.float32(0.5)) / np.float32(2 ** 32)
                drawn = _drawn(sums, u)
                for r in rows:
                    np.add.at(self.seen, r * fan + branch, one)
                    np.add.at(self.drawn, r * fan + drawn, one)


def step(table: np.ndarray, seen: np.ndarray, drawn: np.ndarray, r: int) -> None:
    """Move the weights of ``table`` by the gradient of round ``r``, taken against the counts that were expected."""
    gradient = seen.astype(np.float64) - drawn
    table += (STEP * math.sqrt(2 / (2 + r)) * np.log1p(gradient / (drawn + DAMP))).astype(np.float32)
    np.minimum(table, MOST, out=table)


def log10_probabilities(table: np.ndarray, vocab: Vocabulary, t: Tokens, c: np.ndarray) -> np.ndarray:
    """log10 P of every token; ``c`` are the words' counts, which share out the leaves of several words."""
    out = np.empty(len(t.leaf))
    for at in range(0, len(t.leaf), BATCH):
        part = slice(at, at + BATCH)
        p = np.zeros(len(t.leaf[part]))
        for rows, branch in choices(t, vocab.shape, part):
            x = _logits(table, rows)
            chosen = x[np.arange(len(branch)), branch].astype(np.float64)
            np.exp(x, out=x)
            p += chosen - np.log(np.einsum("ij->i", x).astype(np.float64))
        out[part] = p / np.log(10)
    shared = np.flatnonzero(t.leaf >= vocab.shape.named)
    out[shared] += np.log10((c[shared] + 1) / vocab.tail_mass[t.leaf[shared] - vocab.shape.named])
    return out


# ---- Spark side ----------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all rows, the end of each text included; summed in the tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        texts = 0
        for part in text_slices(batches):
            counts = word_array(text_bytes(part.column("text")), ASCII_LOWER_WORDS)[0].value_counts()
            held.append(pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "c"]))
            texts += part.num_rows
            if sum(x.num_rows for x in held) > FLUSH:
                held = _summed(held)
                if held[0].num_rows > FLUSH // 2:
                    yield held.pop()
        yield from _summed([*held, pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([texts], pa.int64())], ["word", "c"])])
    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _summed(counts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """One record of (word, c) that adds up the given ones."""
    total = pa.Table.from_batches(counts).group_by("word").aggregate([("c", "sum")])
    return total.rename_columns(["word", "c"]).combine_chunks().to_batches()


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Sizes, the frequent words, and their counts by rank (the end of text is always among them)."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    shape = Shape.of(v)
    top = counts.orderBy((F.col("word") == F.lit(END)).desc(), F.col("c").desc(), "word").limit(shape.named).collect()
    top.sort(key=lambda r: (-r.c, bytes(r.word)))
    head = {bytes(r.word): i for i, r in enumerate(top)} or {END: 0}
    vocab = Vocabulary(head, n, v, shape, np.ones(shape.tails))

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(shape.tails, np.int64)
        for batch in batches:
            leaf = vocab.leaves(hashes_of(batch.column("word").to_pylist()))
            shared = leaf >= shape.named
            np.add.at(mass, leaf[shared] - shape.named, batch.column("c").to_numpy()[shared] + 1)
        used = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(mass[used])], ["leaf", "mass"])

    for k, m in counts.select("word", "c").mapInArrow(masses, "leaf long, mass long").groupBy("leaf").agg(F.sum("mass")).collect():
        vocab.tail_mass[k] += m
    return vocab, np.array([r.c for r in top], np.float64)


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The hash of each word, 0 for the end of a text."""
    out = np.zeros(len(words), _U64)
    real = np.array([w != END for w in words], bool)
    out[real] = word_hashes([w for w in words if w != END])[0]
    return out


def start_weights(vocab: Vocabulary, counts: np.ndarray) -> np.ndarray:
    """Zero but for the rows of the nodes, which hold the unigram distribution; branches without a word are shut."""
    shape = vocab.shape
    leaves = np.zeros(shape.fan ** 3)
    leaves[:len(counts)] = counts
    leaves[shape.named:] = vocab.tail_mass
    table = np.zeros((shape.rows, shape.fan), np.float32)
    under = leaves.reshape(-1, shape.fan)
    for first in (1 + shape.fan, 1, 0):
        whole = under.sum(axis=1, keepdims=True)
        share = np.divide(under, whole, out=np.zeros_like(under), where=whole > 0)
        table[first:first + len(under)] = np.where(share > 0, np.log(np.maximum(share, 1e-30)), SHUT)
        under = whole.reshape(-1, shape.fan) if first else under
    return table


def train(docs: DataFrame, vocab: Vocabulary, counts: np.ndarray, size: int) -> np.ndarray:
    """The weights after all rounds over ``docs``, which hold about ``size`` bytes of text.

    A task sends the parts of the table its tokens have touched, as whole numbers, so it doesn't matter how
    documents are dealt to tasks. Every document is learnt from in one round.
    """
    sc = docs.sparkSession.sparkContext
    table = start_weights(vocab, counts)
    fan = vocab.shape.fan
    # each task sends what it has touched, so few tasks send less; past TASK_BYTES a task would be long to lose
    most, least = (math.ceil(size / ROUNDS / b) for b in TASK_BYTES)
    tasks = max(1, min(docs.rdd.getNumPartitions(), max(least, min(most, sc.defaultParallelism))))
    schema = "piece long, counts binary"

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros((2, PIECE * fan), np.int64)
        for counts in rows.column("counts").to_pylist():
            total += _unpacked(counts, fan)
        return pa.table({"piece": [key[0].as_py()], "counts": [_packed(total)]})

    words = sc.broadcast(vocab)
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    for r in range(ROUNDS):
        shared = sc.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, table, g = words.value, shared.value, None
            for part in text_slices(batches):
                g = g or Gradient(table, vocab.shape)
                ids = part.column("doc_id").fill_null(0).to_numpy()
                g.add(Tokens(text_bytes(part.column("text")), vocab), ids)
            for at in range(0, len(table) if g else 0, PIECE):
                both = np.stack([x[at * fan:(at + PIECE) * fan] for x in (g.seen, g.drawn)])
                if both.any():
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_packed(both)], pa.binary())], ["piece", "counts"])

        parts = docs.where(dealt == r).select("doc_id", "text").coalesce(tasks).mapInArrow(run, schema)
        if tasks > LANE:  # in two steps, so that no task adds up the pieces of every other task
            parts = parts.groupBy("piece", (F.spark_partition_id() % math.isqrt(tasks)).alias("lane")).applyInArrow(add, schema)
        for piece, counts in parts.groupBy("piece").applyInArrow(add, schema).collect():
            seen, drawn = _unpacked(counts, fan).reshape(2, PIECE, fan)
            step(table[piece:piece + PIECE], seen, drawn, r)
        shared.destroy()
    return table


def _packed(counts: np.ndarray) -> bytes:
    """The counts in the shortest numbers that hold them; most are 0, which compresses."""
    size = next(n for n in (1, 2, 4, 8) if counts.max(initial=0) < 256 ** n // 2)
    return bytes([size]) + pa.Codec("zstd", 3).compress(counts.astype(f"<i{size}").tobytes(), asbytes=True)


def _unpacked(data: bytes, fan: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(data[1:], 2 * PIECE * fan * data[0], asbytes=True)
    return np.frombuffer(raw, f"<i{data[0]}").reshape(2, PIECE * fan)


def with_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, block): runs of rows of one file that hold about BLOCK_BYTES of text; and the bytes of all text."""
    rows_at = located(docs)
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()
    rows = max(1, int(BLOCK_BYTES * n / max(size, 1)))
    return rows_at.select("doc_id", "text", F.xxhash64("file", F.floor(F.col("row") / rows)).alias("block")), size


def block_words(blocks: DataFrame) -> DataFrame:
    """(block, word): each distinct word of a block, once for each task that reads part of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for part in text_slices(batches):
            block = part.column("block").to_numpy()
            for a, b in _runs(block):
                if block[a] != now:
                    yield from _named(now, held)
                    now, held = int(block[a]), []
                held.append(word_array(text_bytes(part.column("text").slice(a, b - a)), ASCII_LOWER_WORDS)[0].unique())
                if sum(map(len, held)) > FLUSH:
                    held = [_distinct(held)]
                    if len(held[0]) > FLUSH // 2:
                        yield from _named(now, held)
                        held = []
        yield from _named(now, held)
    return blocks.mapInArrow(run, "block long, word binary")


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.r_[0, np.flatnonzero(x[1:] != x[:-1]) + 1, len(x)]
    return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def _distinct(words: list[pa.Array]) -> pa.Array:
    return pa.chunked_array(words, pa.binary()).unique()


def _named(block: int | None, words: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    if words:
        found = _distinct(words)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block, np.int64)), found], ["block", "word"])


def score_documents(docs: DataFrame, trains: Callable[[Column], Column] = learns_from) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased words and one end for each text; null and empty
    texts are the end alone. ``base_score`` is the add-one unigram log10
    probability, ``score`` the model's; both use counts of all training texts.
    Rows without an id are trained on and not held out. With no training text every count is 0.
    """
    docs, size = with_blocks(docs)
    taught = docs.where(trains(F.col("doc_id")))
    counts = stored(word_counts(taught), "lm-counts")
    vocab, top = vocabulary(counts)
    weights = train(taught, vocab, top, size)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, weights))
    ends = vocab.head.get(END)
    end_count = int(top[ends]) if ends is not None and len(top) else 0
    known = block_words(docs).join(counts, "word").select("block", "word", "c")

    def run(key: tuple, texts: pa.Table, words: pa.Table) -> pa.Table:
        vocab, weights = shared.value
        parts = list(text_slices(texts.combine_chunks().to_batches()))
        split = [word_array(text_bytes(part.column("text")), ASCII_LOWER_WORDS)[0] for part in parts]
        # one call, as each builds its table of the block's words anew; a word that isn't known gets the 0 behind the counts
        c = np.r_[words.column("c").to_numpy(), 0].astype(np.float64)
        places = pc.index_in(pa.chunked_array(split, pa.binary()), words.column("word").combine_chunks())
        places = places.fill_null(len(c) - 1).to_numpy()
        ends = np.cumsum([len(x) for x in split])
        out = []
        for part, place in zip(parts, np.split(places, ends[:-1]), strict=True):
            texts_now = text_bytes(part.column("text"))
            t = Tokens(texts_now, vocab)
            seen = np.full(len(t.leaf), end_count, np.float64)
            seen[t.inside] = c[place]
            begins = t.ends - t.lengths + 1
            base = np.log10((seen + 1) / (vocab.n + vocab.v + 1))
            out.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(t.lengths, pa.int64()), pa.array(np.add.reduceat((seen > 0).astype(np.int64), begins)),
                 pa.array(np.add.reduceat(base, begins)), pa.array(np.add.reduceat(log10_probabilities(weights, vocab, t, seen), begins))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"]))
        return pa.Table.from_batches(out, _SCORED)

    scored = docs.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", (~trains(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", F.lit(vocab.n).cast("long").alias("train_tokens"), "base_score", "score")


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
