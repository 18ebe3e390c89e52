"""Near-duplicate detection by circulant MinHash, banding and exact Jaccard verification.

Two permutations make the whole signature: sigma scatters the shingles over a
circle of 2^32 places, pi ranks the places, and coordinate k is the smallest rank
after the circle is turned by k places. Signatures are cut into bands; documents
that agree in a band are candidates, and a link holds only when the full shingle
sets confirm it.

No bucket is expanded into all its pairs. Equal sets are folded first. A bucket
is then compared with one pivot at a time, links are merged into components, and
only members of different components are looked at again. After a few pivots, the
documents of buckets that still hold several components meet by their rarest
shingles: two sets of similarity 0.85 must share one of the rarest 15 % of either
(in one order of all shingles by frequency), and bit marks of the sets bound what
two of them share, so documents that have only common
passages in common are never paired, and no pair that shares a bucket is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ASCII_LOWER_WORDS, id_text, split_words, stored, text_bytes, text_slices

SHINGLE, LINK_PERCENT = 5, 85
#: At similarity 0.85 all bands miss a pair with probability (1 - 0.85^8)^32 = 4e-5.
BANDS, ROWS = 32, 8
#: Pivots a bucket is compared with before its documents meet by rare shingles; any number gives the same links.
PIVOT_ROUNDS = 1
#: Words of 64 bits that mark which shingles a document has, for a bound on what two documents share.
MARKS = 16
#: Distinct words whose hash a task remembers.
CACHE_WORDS = 200_000

_U64, _U32 = np.uint64, np.uint32
_PLACES = np.random.Generator(np.random.PCG64(9)).integers(1, 1 << 63, SHINGLE + 1, dtype=_U64) * _U64(2) + _U64(1)
_BAND_MIX = np.random.Generator(np.random.PCG64(10)).integers(1, 1 << 63, (BANDS, ROWS + 1), dtype=_U64) * _U64(2) + _U64(1)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS and len(word) <= 64:
            self[word] = h
        return h


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def shingle_sets(texts: list[bytes], known: dict) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, of none has none."""
    words, off = split_words(texts, ASCII_LOWER_WORDS)
    w = np.fromiter(map(known.__getitem__, words), _U64, len(words))
    h = np.zeros(max(0, len(w) - SHINGLE + 1), _U64)
    for j in range(SHINGLE):
        h += w[j:j + len(h)] * _PLACES[j]
    h = _mix64(h)
    sets = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            sets.append(np.unique(h[a:b - SHINGLE + 1]))
        else:
            n = b - a
            sets.append(_mix64((w[a:b] * _PLACES[:n]).sum(keepdims=True, dtype=_U64) + _PLACES[SHINGLE:] * _U64(n)) if n else w[a:a])
    return sets


def _sigma(x: np.ndarray) -> np.ndarray:
    return ((x * _U64(0x9E3779B97F4A7C15)) >> _U64(32)).astype(_U32)


def _pi(x: np.ndarray, tmp: np.ndarray) -> None:
    """Rank every place of ``x`` in place (a permutation of 32-bit numbers)."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 0)):
        np.right_shift(x, _U32(shift), out=tmp)
        np.bitwise_xor(x, tmp, out=x)
        if factor:
            np.multiply(x, _U32(factor), out=x)


def signatures(sets: list[np.ndarray], coordinates: int = BANDS * ROWS) -> np.ndarray:
    """One row of circulant MinHash coordinates for each set; none may be empty."""
    if not sets:
        return np.zeros((0, coordinates), _U32)
    sizes = np.array([len(s) for s in sets])
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    places = _sigma(np.concatenate(sets))
    out = np.empty((coordinates, len(sets)), _U32)
    x, tmp = np.empty_like(places), np.empty_like(places)
    for k in range(coordinates):
        np.add(places, _U32(k), out=x)
        _pi(x, tmp)
        np.minimum.reduceat(x, starts, out=out[k])
    return out.T


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.astype(_U64).reshape(len(sig), BANDS, ROWS)
    return _mix64((rows * _BAND_MIX[:, :ROWS]).sum(axis=2, dtype=_U64) + _BAND_MIX[:, ROWS]).view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _with_text_hash(docs: DataFrame) -> DataFrame:
    """doc_id, text and the hash of the text, which with the id tells rows apart."""
    base = id_text(docs)
    return base.withColumn("text_hash", F.xxhash64("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, text_hash, n_shingles, digest of the set (null if empty), bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for part in text_slices(batches):
            sets = shingle_sets(text_bytes(part.column("text")), known)
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(signatures(full)).tolist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n_shingles", "digest", "bands"])
    return _with_text_hash(docs).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>")


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) of the given (node, rep): sorted 64-bit shingle hashes as bytes. The node is the hash of the
    set's digest, so of an id on several texts each set is its own node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for part in text_slices(batches):
            sets = shingle_sets(text_bytes(part.column("text")), known)
            node = np.array([xxhash.xxh64_intdigest(_digest(s), 42) for s in sets], np.uint64).view(np.int64)
            own = pa.array(node == part.column("node").to_numpy())
            found = [part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(found, ["node", "set"]).filter(own)
    base = id_text(docs)
    # a row meets every node of its id, and stands for its own
    return base.join(nodes, base.doc_id == nodes.rep).select("text", "node").mapInArrow(run, "node long, set binary")


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (a, b, common, total): sizes of the intersection and the union of each pair's full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            common, total = [], []
            for x, y in zip(part.column("x"), part.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), _U64), np.frombuffer(y.as_buffer(), _U64)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                common.append(both)
                total.append(len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(common, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "common", "total"])
    x = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, common long, total long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of the edges (a, b): the smallest node it reaches.

    Each round takes the smallest label among a node and its neighbours, then the
    label of that label, so a chain shortens by more than half each round.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        seen = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        near = stored(
            labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"{name}-{step}n")
        up = near.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = stored(near.join(up, "label").select("node", "old", F.col("above").alias("label")), f"{name}-{step}")
        labels = new.select("node", "label")
        if new.where("label != old").isEmpty():
            return labels


def _rare_shingles(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, n, comp, shingle, at, marks): for each node the shingles of its prefix that any other node has, too, with their place.

    Shingles are ordered by the number of ``nodes`` that have them. Two sets with
    100 * common >= 85 * total share at least 85 % of either set, so the first
    n - ceil(0.85 n) + 1 of each must have one in common. Those nobody shares come first and match nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, 256):
                piece = part.slice(at, 256)
                values = [np.frombuffer(x.as_buffer(), np.int64) for x in piece.column("set")]
                of = np.repeat(np.arange(len(values)), [len(v) for v in values])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("node").take(pa.array(of)), pa.array(np.concatenate(values))], ["node", "shingle"])
    each = stored(sets.join(nodes.select("node"), "node", "left_semi").mapInArrow(run, "node long, shingle long"), "near-shingles")
    often = stored(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "near-often")
    marks = each.groupBy("node").agg(*(
        F.expr(f"coalesce(bit_or(CASE WHEN (shiftright(shingle, 6) & {MARKS - 1}) = {i} THEN shiftleft(1L, CAST(shingle & 63 AS INT)) END), 0L)").alias(f"m{i}")
        for i in range(MARKS)))
    known = each.join(often, "shingle").groupBy("node").agg(
        F.sort_array(F.collect_set(F.struct("often", "shingle"))).alias("known")).join(nodes, "node")
    prefix = F.col("n") - F.ceil(F.col("n") * LINK_PERCENT / 100) + 1
    alone = F.col("n") - F.size("known")
    first = F.slice("known", 1, F.greatest(prefix - alone, F.lit(0)).cast("int"))
    return known.join(marks, "node").select(
        "node", "n", "comp", *_MARK_COLUMNS, alone.alias("alone"), F.posexplode(first).alias("i", "f")).select(
        "node", "n", "comp", "f.shingle", (F.col("alone") + F.col("i")).alias("at"), *_MARK_COLUMNS)


_MARK_COLUMNS = tuple(f"m{i}" for i in range(MARKS))


def _only_in(side: str, other: str) -> Column:
    """At least so many shingles of one document are missing in the other: marks that only the one has."""
    out = F.lit(0)
    for c in _MARK_COLUMNS:
        out = out + F.bit_count(F.col(side + c).bitwiseAND(F.bitwise_not(F.col(other + c))))
    return out


def _pairs_of_rare(rare: DataFrame) -> DataFrame:
    """Pairs of different components that share a rare shingle; the largest component of a shingle is not paired with itself."""
    per = rare.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("k"))
    top = per.groupBy("shingle").agg(F.max_by("comp", "k").alias("top"), F.count(F.lit(1)).alias("comps"))
    top = stored(top.where("comps > 1").select("shingle", "top"), "near-top")
    rare = stored(rare.join(top, "shingle"), "near-rare")
    other = rare.select("shingle", *(F.col(c).alias(f"p_{c}") for c in ("node", "n", "comp", "at", *_MARK_COLUMNS)))
    # From the first shingle that two sets share, no more can follow than what is left of either.
    left = F.least(F.col("n") - F.col("at"), F.col("p_n") - F.col("p_at"), F.col("n") - _only_in("", "p_"), F.col("p_n") - _only_in("p_", ""))
    enough = (100 + LINK_PERCENT) * left >= LINK_PERCENT * (F.col("n") + F.col("p_n"))
    return rare.where("comp != top").join(other, "shingle").where(enough & (F.col("comp") != F.col("p_comp")))


def near_links(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, comp): each set as digest, node, rep (its smallest id), copies; component of each linked set as node, comp.

    Sets, not ids, are linked: a set's node is the hash of its digest.
    """
    ids = rows.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    groups = stored(ids.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).withColumn("node", F.xxhash64("digest")), "near-groups")
    one = ids.join(groups.select(F.col("digest").alias("_d"), "rep"), (F.col("digest") == F.col("_d")) & (F.col("doc_id") == F.col("rep")), "left_semi")
    banded = stored(one.select(
        F.xxhash64("digest").alias("node"), F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key")), "near-banded")
    shared = stored(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "near-buckets")
    met = stored(banded.join(shared, "key"), "near-members")
    sets = stored(_sets_of(docs, met.select("node", "rep").distinct()), "near-sets")
    members = met.drop("rep")
    comp = stored(members.select("node", F.col("node").alias("comp")).distinct(), "near-comp")
    tested = None
    for turn in range(PIVOT_ROUNDS + 1):
        open_ = members.join(comp, "node") if turn else members.withColumn("comp", F.col("node"))
        first = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
        pivots = open_.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), *(F.min_by(c, first).alias(f"p_{c}") for c in ("node", "n", "comp")),
        ).where("lo != hi").drop("lo", "hi")
        pivots = stored(pivots, f"near-pivots-{turn}")
        if pivots.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            pairs = open_.join(pivots, "key").where("comp != p_comp")
        else:
            nodes = stored(open_.join(pivots.select("key"), "key", "left_semi").select("node", "n", "comp").distinct(), "near-open")
            pairs = _pairs_of_rare(_rare_shingles(nodes, sets))
        pairs = pairs.where(100 * F.least("n", "p_n") >= LINK_PERCENT * F.greatest("n", "p_n"))
        pairs = pairs.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        found = stored(_compare(stored(pairs, f"near-pairs-{turn}"), sets), f"near-compared-{turn}")
        tested = found.select("a", "b") if tested is None else tested.union(found.select("a", "b"))
        links = found.where(100 * F.col("common") >= LINK_PERCENT * F.col("total")).select("a", "b")
        for side in ("a", "b") if turn else ():
            links = links.join(comp.withColumnRenamed("node", side), side).drop(side).withColumnRenamed("comp", side)
        links = stored(links.distinct(), f"near-links-{turn}")
        if links.isEmpty():
            continue
        merged = components(links, f"near-cc-{turn}").withColumnRenamed("node", "comp")
        comp = stored(
            comp.join(merged, "comp", "left").select("node", F.coalesce("label", "comp").alias("comp")), f"near-comp-{turn}")
    return groups, comp


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links join documents whose distinct 5-word shingles have 100 * intersection
    >= 85 * union; component_id is the smallest doc_id reachable. Null, empty and
    wordless texts have no shingles, link with nothing and are their own
    component. Texts of fewer than five words link only with equal word
    sequences. Rows without an id keep a null component and stay. Rows are linked by their sets
    alone: an id on several texts stands for as many documents, each in its own text's component.
    """
    return _judged(docs).drop("text_hash")


def _judged(docs: DataFrame) -> DataFrame:
    """The rows of ``near_duplicates`` with ``text_hash``."""
    rows = stored(sketches(docs), "near-sketches")
    groups, comp = near_links(docs, rows)
    led = groups.join(comp, "node")
    smallest = stored(led.groupBy("comp").agg(F.min("rep").alias("found")), "near-smallest")
    linked = led.join(smallest, "comp").select("digest", "found")
    copies = groups.where("copies > 1").join(comp, "node", "left_anti").select("digest", F.col("rep").alias("found"))
    found = stored(linked.union(copies), "near-found")
    out = rows.select("doc_id", "text_hash", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns: one document of each component, the one with the smallest id.

    Each row is judged by its id and its text (a 64-bit hash of it), so an id on a near copy and on a clean text keeps the
    clean one. Rows without an id stay. Of two texts in one component under its smallest id both stay.
    """
    gone = _judged(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    text = F.xxhash64(docs["text"].cast("string"))
    return docs.join(gone, (docs["doc_id"].cast("long") == F.col("_id")) & (text == F.col("_hash")), "left_anti")
