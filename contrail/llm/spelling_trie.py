"""Spelling variants by a trie over letter-group counts.

Letters are dealt into groups, and a word is the vector of its counts of
letters from each group. The vectors form a trie: a level for each group, a child
for each count, and the words of a vector at its leaf. Two words that differ by
one inserted, deleted or replaced letter have vectors with at most one surplus
and one deficit of one, so a depth-first search with a budget of one each meets
all near words of a word. Their leaf words are then compared letter by letter.

Each pair is met once: a search looks for the longer word, so that a surplus is
spent first, and for a replacement whose surplus comes on an earlier level than
its deficit; a surplus and a deficit in the same group leave the leaf as it is.

Spark cuts the trie into subtrees by the counts of its first groups, as many of
them as it takes for a subtree to have a bounded number of words; what a single
vector holds beyond that is dealt into pieces. A word stands in its own subtree
and is sent as a search to the few that its budget reaches; one task holds one
subtree and a bounded number of searches at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import id_text, stored, text_slices

MIN_LENGTH, MIN_COUNT, DELETE_EVERY, FORM_TIMES = 7, 2, 31, 10
#: Letter c is of group c mod GROUPS, which parts the vowels and the common consonants.
GROUPS = 11
#: Words of a subtree, and searches over it, that a task holds.
SUBTREE, SEARCHES = 20_000, 80_000
#: Open branches of a search that are followed at once.
FRONTIER = 1 << 18
#: Distinct words a task counts before it passes them on.
COUNTED = 200_000

_RUNS = re.compile(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(doc_id: int | None, text: bytes) -> Iterator[str]:
    """The words of a text, with a letter deleted where the hash of id and run says so."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run in _RUNS.findall(text.translate(_LOWER).decode()):
        h = zlib.crc32(run.encode(), start)
        if h % DELETE_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_LENGTH:
                continue
        yield run


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least MIN_COUNT occurrences over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return found
        for part in text_slices(batches):
            texts = pc.fill_null(part.column("text").cast(pa.binary()), b"")
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                counts.update(words_of(doc_id, text.as_py()))
            if len(counts) > COUNTED:
                yield out()
        yield out()
    each = id_text(docs).mapInArrow(run, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def vectors(words: list[bytes]) -> np.ndarray:
    """The counts of each letter group for words in Latin-1, a row per word."""
    letters = np.frombuffer(b"".join(words), np.uint8)
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(of * GROUPS + letters % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def with_vectors(words: DataFrame) -> DataFrame:
    """The words (word, n) with ``v``, the array of their group counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            v = vectors([w.encode("latin-1") for w in part.column("word").to_pylist()])
            flat = pa.array(v.ravel(), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, GROUPS), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([part.column("word"), part.column("n"), lists], ["word", "n", "v"])
    return words.select("word", "n").mapInArrow(run, "word string, n long, v array<int>")


class Trie:
    """The trie of some words' vectors: on each level the sorted (parent, count) of its nodes, at the leaves the words."""

    def __init__(self, v: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.base = int(v.max(initial=0)) + 3
        node = np.zeros(len(v), np.int64)
        for g in range(GROUPS):
            keys, node = np.unique(node * self.base + v[:, g] + 1, return_inverse=True)
            self.levels.append(keys)
        self.words = np.argsort(node, kind="stable")
        self.starts = np.r_[0, np.cumsum(np.bincount(node, minlength=len(self.levels[-1]) if len(v) else 0))]

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The child with that count, or -1."""
        keys, want = self.levels[level], node * self.base + np.clip(count + 1, 0, self.base - 1)
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return np.where(keys[at] == want, at, -1)

    def search(self, v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(search, leaf, spent) of all leaves in reach of each search, depth first over bounded batches of branches.

        spent: 0 nothing, 1 a surplus, 2 a surplus and then a deficit.
        """
        n = len(v)
        stack = [(0, np.arange(a, min(a + FRONTIER, n)), None, None) for a in range(0, n, FRONTIER)]
        while stack:
            level, q, node, spent = stack.pop()
            if node is None:
                node, spent = np.zeros(len(q), np.int64), np.zeros(len(q), np.int8)
            if level == GROUPS:
                yield q, node, spent
                continue
            own, found = v[q, level], []
            for step, of, then in ((0, None, None), (1, 0, 1), (-1, 1, 2)):
                may = np.arange(len(q)) if of is None else np.flatnonzero(spent == of)
                child = self.child(level, node[may], own[may] + step)
                may, child = may[child >= 0], child[child >= 0]
                found.append((q[may], child, spent[may] if then is None else np.full(len(may), then, np.int8)))
            q, node, spent = (np.concatenate(x) for x in zip(*found, strict=True))
            stack += [(level + 1, q[a:a + FRONTIER], node[a:a + FRONTIER], spent[a:a + FRONTIER]) for a in range(0, len(q), FRONTIER)]


class Letters:
    """Words as bytes of one array, for comparing many pairs at once."""

    def __init__(self, words: list[bytes]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.at = np.r_[0, np.cumsum(self.size)][:-1]
        self.data = np.frombuffer(b"".join(words) + b"\0", np.uint8)

    def same(self, i: np.ndarray, other: Letters, j: np.ndarray, backwards: bool) -> np.ndarray:
        """Letters that the words i and j have in common from the start, or from the end."""
        most = np.minimum(self.size[i], other.size[j])
        out, open_ = np.zeros(len(i), np.int64), np.flatnonzero(most > 0)
        a = self.at[i] + (self.size[i] - 1 if backwards else 0)
        b = other.at[j] + (other.size[j] - 1 if backwards else 0)
        step, k = (-1 if backwards else 1), 0
        while len(open_):
            open_ = open_[self.data[a[open_] + step * k] == other.data[b[open_] + step * k]]
            k += 1
            out[open_] = k
            open_ = open_[most[open_] > k]
        return out


def one_edit(a: Letters, i: np.ndarray, b: Letters, j: np.ndarray) -> np.ndarray:
    """Whether the words differ by exactly one inserted, deleted or replaced letter."""
    longer, d = np.maximum(a.size[i], b.size[j]), np.abs(a.size[i] - b.size[j])
    head = a.same(i, b, j, False)
    near = np.flatnonzero((d <= 1) & (head < longer))
    tail = a.same(i[near], b, j[near], True)
    out = np.zeros(len(i), bool)
    # a replaced letter, or the extra one, is all that the common head and tail leave; they may overlap by repeated letters
    short = np.minimum(a.size[i[near]], b.size[j[near]])
    out[near] = np.where(d[near] == 0, head[near] + tail == short - 1, head[near] + tail >= short)
    return out


def near_in_subtree(tree: pa.Table, searches: pa.Table) -> Iterator[pa.RecordBatch]:
    """(a, a_n, b, b_n): pairs of a search's word and a near word of the subtree."""
    def read(t: pa.Table) -> tuple[Letters, np.ndarray]:
        v = t["v"].combine_chunks()
        return Letters([w.encode("latin-1") for w in t["word"].to_pylist()]), pc.list_flatten(v).to_numpy().astype(np.int64).reshape(-1, GROUPS)
    if not tree.num_rows or not searches.num_rows:
        return
    (words, v), (asked, asked_v) = read(tree), read(searches)
    trie = Trie(v)
    for q, leaf, spent in trie.search(asked_v):
        n = trie.starts[leaf + 1] - trie.starts[leaf]
        at = 0
        for end in [*np.flatnonzero(np.diff(np.cumsum(n) // FRONTIER)) + 1, len(n)]:
            i = np.repeat(np.arange(at, end), n[at:end])
            place = np.arange(len(i)) - np.repeat(np.cumsum(n[at:end]) - n[at:end], n[at:end])
            j = trie.words[trie.starts[leaf[i]] + place]
            i, own_leaf = q[i], spent[i] == 0
            ok = np.flatnonzero(one_edit(asked, i, words, j))
            at = end
            if len(ok):
                a, b = searches.take(pa.array(i[ok])), tree.take(pa.array(j[ok]))
                found = pa.table({"a": a["word"], "a_n": a["n"], "b": b["word"], "b_n": b["n"]})
                # words of one leaf meet from both sides
                found = found.filter(pc.or_(pa.array(~own_leaf[ok]), pc.less(found["a"], found["b"])))
                yield from found.combine_chunks().to_batches()


def _subtree(v: Column, depth: int) -> Column:
    """The number of a subtree: its first counts, hashed."""
    return F.xxhash64(F.slice(v, 1, depth))


def _reached(v: Column, depth: int) -> Column:
    """The numbers of all subtrees that a search reaches: no step, a surplus, or a surplus and a later deficit."""
    def stepped(plus: int | None, minus: int | None) -> Column:
        at = [F.element_at(v, g + 1) + F.lit((g == plus) - (g == minus)) for g in range(depth)]
        return F.xxhash64(F.array(*at))
    ways = [(None, None), *((p, None) for p in range(depth)), *((p, m) for p in range(depth) for m in range(p + 1, depth))]
    return F.array_distinct(F.array(*(stepped(p, m) for p, m in ways)))


def subtree_depth(words: DataFrame) -> int:
    """The first groups it takes until no subtree has over SUBTREE words; all of them where a vector alone has more."""
    per = stored(words.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "trie-vectors")
    for depth in range(2, GROUPS):
        most = per.groupBy(_subtree(F.col("v"), depth)).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if (most or 0) <= SUBTREE:
            return depth
    return GROUPS


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of near words of (word, n) once, as (a, a_n, b, b_n)."""
    words = stored(with_vectors(words), "trie-words")
    depth = subtree_depth(words)
    leaves = words.withColumn("tree", _subtree(F.col("v"), depth))
    # columns of the searches have names of their own, as the cogroup asks
    asked = words.select(F.col("word").alias("s_word"), F.col("n").alias("s_n"), F.col("v").alias("s_v"), F.explode(_reached(F.col("v"), depth)).alias("tree"))
    # pieces of a subtree's words and of its searches; a subtree nobody is in is not searched
    size = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("leaves"))
    busy = asked.groupBy("tree").agg(F.count(F.lit(1)).alias("asks"))
    pieces = stored(size.join(busy, "tree").select(
        "tree", F.ceil(F.col("leaves") / SUBTREE).cast("int").alias("p"), F.ceil(F.col("asks") / SEARCHES).cast("int").alias("r")), "trie-pieces")
    leaves = leaves.join(pieces, "tree").withColumn("p", F.pmod(F.xxhash64("word", F.lit(1)), F.col("p")).cast("int")).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.col("r") - 1)))
    asked = asked.join(pieces, "tree").withColumn("r", F.pmod(F.xxhash64("s_word", F.lit(1)), F.col("r")).cast("int")).withColumn(
        "p", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(near_in_subtree(left, right.select(["s_word", "s_n", "s_v"]).rename_columns(["word", "n", "v"])))
        return pa.Table.from_batches(found, _PAIRS) if found else _PAIRS.empty_table()
    return leaves.groupBy("tree", "p", "r").cogroup(asked.groupBy("tree", "p", "r")).applyInArrow(run, "a string, a_n long, b string, b_n long")


_PAIRS = pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form, following (word, form) to the last.

    Each step follows twice as many forms as the one before; a form has at least
    ten times its word's occurrences, so chains are short.
    """
    step, at = 0, stored(forms.select("word", F.col("form").alias("root")), "trie-roots-0")
    while True:
        step += 1
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                     f"trie-roots-{step}")
        at = new.select("word", "root")
        if new.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, with
    one letter deleted where 31 divides the crc32 of ``<doc_id>:<run>``; of at least
    seven letters and two occurrences. Null and empty texts have none; a null id is
    written as nothing in the hash. Every row counts, repeated ones too. Runs of any
    length are words. ``form`` is the near word with the most occurrences (of equal
    ones the first in code-point order) if it has ten times the word's at least.
    """
    counts = stored(word_counts(docs), "trie-counts")
    pairs = stored(near_pairs(counts), "trie-pairs")
    both = pairs.union(pairs.select("b", "b_n", "a", "a_n"))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    out = counts.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(-F.col("best.less") >= FORM_TIMES * F.col("n"), F.col("best.form")).alias("form"),
        (-F.col("best.less")).alias("form_n"))
    out = stored(out.withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("form_n"))), "trie-forms")
    last = roots(out.where("form IS NOT NULL"))
    return out.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
