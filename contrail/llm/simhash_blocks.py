"""Near-duplicate detection by SimHash with pigeonhole blocks and Hamming verification.

A text's fingerprint has a bit set where over half of its shingle hashes have
it. Fingerprints that differ in at most three bits are linked. The 64 bits are
split into six blocks: three differing bits leave at least three blocks
untouched, so a close pair agrees on one of the twenty choices of three blocks.
Every distinct fingerprint is written under those twenty keys, fingerprints meet
by key, and the Hamming distance is verified inside the join.

A key that few fingerprints share is joined with itself. In a crowded one all
are compared with one pivot first, the links are merged into components, and
where several components are left the other half of the bits is split again
into six blocks: a close pair agrees on three of those, too. The largest
component of such a finer key is never paired with itself, so a dense cluster
costs links to its centre, not its square, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.circulant_minhash import components
from contrail.llm.common import ASCII_LOWER_WORDS, id_text, stored, text_bytes, text_slices

SHINGLE, SEED = 3, 42
#: Fingerprints that differ in at most so many bits are linked.
DISTANCE = 3
#: Cuts of the 64 bits into six blocks, and of the bits outside three of them (33 at most).
CUTS, REST_CUTS = (0, 11, 22, 33, 43, 53, 64), (0, 5, 11, 16, 22, 27, 33)
#: Fingerprints of a key that are compared outright; a larger one goes by pivots. Any number gives the same components.
CROWD = 64
#: Shingles whose bits are counted at once.
PIECE = 1 << 16


def _words(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The lower-cased words joined by single spaces, with the start and end of each."""
    raw = np.frombuffer(text.translate(ASCII_LOWER_WORDS), np.uint8)
    word = raw != 32
    keep = word.copy()
    keep[1:] |= word[:-1]
    raw, word = raw[keep], word[keep]
    starts = np.flatnonzero(word & ~np.r_[False, word[:-1]])
    ends = np.flatnonzero(word & ~np.r_[word[1:], False]) + 1
    return raw.tobytes(), starts, ends


def fingerprint(text: bytes) -> int:
    """The 64 bits of a text; 0 without words, the one shingle of a text of fewer than three words."""
    data, starts, ends = _words(text)
    n = len(starts)
    if not n:
        return 0
    starts, ends = starts[:max(1, n - SHINGLE + 1)], ends[min(n, SHINGLE) - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), PIECE):
        shingles = zip(starts[at:at + PIECE].tolist(), ends[at:at + PIECE].tolist(), strict=True)
        h = b"".join([digest(data[a:b], SEED) for a, b in shingles])
        ones += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id and its fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([fingerprint(t) for t in text_bytes(part.column("text"))], pa.int64())], ["doc_id", "fp"])
    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def _chosen(bits: Column, cuts: tuple[int, ...], chosen: tuple[int, ...]) -> Column:
    """The bits of the chosen blocks, pushed together."""
    out, at = F.lit(0).cast("long"), 0
    for i in chosen:
        width = cuts[i + 1] - cuts[i]
        block = F.shiftrightunsigned(bits, cuts[i]).bitwiseAND(F.lit((1 << width) - 1))
        out, at = out.bitwiseOR(F.shiftleft(block, at)), at + width
    return out


def _keys(bits: Column, cuts: tuple[int, ...], room: int) -> Column:
    """An array of (key, rest) for every choice of half of the six blocks; keys have their choice in the bits from ``room``."""
    out = []
    for number, chosen in enumerate(combinations(range(6), DISTANCE)):
        others = tuple(i for i in range(6) if i not in chosen)
        key = _chosen(bits, cuts, chosen).bitwiseOR(F.lit(number << room))
        out.append(F.struct(key.alias("key"), _chosen(bits, cuts, others).alias("rest")))
    return F.array(*out)


def _close(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _across(members: DataFrame) -> DataFrame:
    """Close pairs (a, b) of different components among the (key, fp, comp) of finer keys."""
    per = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
    top = stored(top.where("comps > 1").select("key", "top"), "simhash-top")
    rows = stored(members.join(top, "key"), "simhash-across")
    other = rows.select("key", F.col("fp").alias("b"), F.col("comp").alias("b_comp"))
    pairs = rows.where("comp != top").select("key", F.col("fp").alias("a"), F.col("comp").alias("a_comp"))
    return pairs.join(other, (pairs.key == other.key) & (F.col("a_comp") != F.col("b_comp")) & _close("a", "b")).select("a_comp", "b_comp")


def linked_fingerprints(fps: DataFrame) -> DataFrame:
    """(fp, comp) for every linked fingerprint of the distinct column ``fp``: the smallest of its component."""
    members = stored(fps.select("fp", F.inline(_keys(F.col("fp"), CUTS, 33))), "simhash-blocks")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min_by("fp", F.xxhash64("fp")).alias("pivot")).where("size > 1")
    met = stored(members.join(shared, "key"), "simhash-shared")
    few = met.where(F.col("size") <= CROWD)
    a, b = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    pairs = a.join(b, (a.key == b.key) & (F.col("a") < F.col("b")) & _close("a", "b")).select("a", "b")
    crowd = met.where(F.col("size") > CROWD)
    stars = crowd.where(_close("fp", "pivot") & (F.col("fp") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("fp").alias("b"))
    comp = components(pairs.union(stars), "simhash-cc").select(F.col("node").alias("fp"), F.col("label").alias("comp"))
    crowd = crowd.join(comp, "fp", "left").select("key", "rest", "fp", F.coalesce("comp", "fp").alias("comp"))
    open_ = crowd.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    open_ = stored(crowd.join(open_, "key"), "simhash-open")
    if open_.isEmpty():
        return comp
    # 5 + 33 bits of the key, 5 of the second choice, 18 at most of its blocks
    finer = open_.select("key", "fp", "comp", F.explode(_keys(F.col("rest"), REST_CUTS, 18)).alias("f"))
    finer = finer.select(F.shiftleft("key", 23).bitwiseOR(F.col("f.key")).alias("key"), "fp", "comp")
    links = stored(_across(finer).distinct(), "simhash-late")
    late = components(links.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")), "simhash-late-cc")
    known = comp.union(links.select("a_comp", "a_comp").union(links.select("b_comp", "b_comp"))).distinct()
    known = known.groupBy("fp").agg(F.min("comp").alias("comp"))
    return known.join(late, known.comp == late.node, "left").select("fp", F.coalesce("label", "comp").alias("comp"))


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Shingles are three lower-cased words (A-Z only), repeats included; a text of
    fewer words is one shingle. Null, empty and wordless texts have the
    fingerprint zero and are linked like any other. component_id is the smallest
    doc_id reachable over links of at most three differing bits. Rows without an id
    have a fingerprint and a null component, and join nothing. A repeated id stands
    for as many documents as it has fingerprints: they are linked by their
    fingerprints alone. Texts of any length are counted in pieces of bounded memory.

    Equal fingerprints are folded before the blocks, so copies, however many,
    are one fingerprint; rows get their component by a join of written tables
    that AQE can split.
    """
    rows = stored(fingerprints(docs), "simhash-rows")
    one = rows.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    one = stored(one, "simhash-fps")
    comp = stored(linked_fingerprints(one.select("fp")), "simhash-comp")
    led = one.join(comp, "fp")
    smallest = stored(led.groupBy("comp").agg(F.min("rep").alias("component")), "simhash-smallest")
    linked = led.join(smallest, "comp").select("fp", "component")
    folded = one.where("copies > 1").join(comp, "fp", "left_anti").select("fp", F.col("rep").alias("component"))
    found = stored(linked.union(folded), "simhash-found")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(found, "fp", "left").select("doc_id", digits.alias("fingerprint"), component.alias("component_id"))
