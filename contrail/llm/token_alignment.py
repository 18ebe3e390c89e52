"""Alignment of two tokenizers over the same bytes, on Arrow tables.

A slice of texts is encoded by both tokenizers into list columns. ``list_flatten``
and ``list_parent_indices`` turn a column into one row per token, a cumulative sum
of token lengths less that of the row's first token gives each token's end within
its document, and one Acero outer join of both sides on (document, end) is the
whole alignment: keys found on both sides cut the text into groups, and every
row of the join is one link, between the tokens of A and B that run on at that
place. ``Table.group_by`` counts the links of id pairs in a slice, Spark sums them
over the corpus.

Documents get their sums back by blocks: each block of rows has a list of its own
distinct pairs, which meet the corpus counts in one join, and a cogroup of the
block's rows with its pairs adds them up. A pair that every document has travels
once a block, and links themselves never travel.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import id_text, stored, text_slices

#: Text bytes of a block (one row at least), and of the texts that are encoded and aligned at once.
BLOCK_BYTES, PIECE_BYTES = 4 << 20, 1 << 19
#: An id pair as one number: B's id in the low bits. A document's place and a byte offset in it likewise.
B_BITS, END_BITS = 32, 40
#: A's tokens by ranks take quadratic time in one pre-token; texts with a run of so many characters of a kind go by merges.
LONG_RUN = 4000
_LONG = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")


class Spelling:
    """The bytes of every token of a vocabulary, for joining the tokens of many texts at once."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(x) for x in tokens], np.int64)
        self.start = self.size.cumsum() - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.data[np.repeat(self.start[ids] - (size.cumsum() - size), size) + np.arange(size.sum())]


class Tokenizers:
    """Both tokenizers with the bytes and byte lengths of their tokens."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        import tiktoken

        self.a_json, self.by_merges = a_json, None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        model = json.loads(a_json)["model"]
        known = byte_letters()
        entries = {i: bytes(map(known.__getitem__, e)) for e, i in model["vocab"].items() if set(e) <= known.keys()}
        self.a_spelling = Spelling([entries.get(i, b"") for i in range(max(model["vocab"].values()) + 1)])
        self.b_spelling = Spelling([self._piece(i) for i in range(self.b.get_piece_size())])
        # merges in the order of their tokens' ids say the same as the ids taken as ranks, which is the quicker way
        made = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        self.by_ranks = None
        if made == sorted(made) and 256 + len(made) == len(set(made) | {i for i, e in entries.items() if len(e) == 1}):
            ranks = {entries[i]: i for i in {*made, *(i for i, e in entries.items() if len(e) == 1)}}
            self.by_ranks = tiktoken.Encoding("a", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> np.ndarray:
        if self.by_ranks is not None and not (len(text) >= LONG_RUN and _LONG.search(text)):
            return self.by_ranks.encode_to_numpy(text)
        if self.by_merges is None:
            from tokenizers import Tokenizer
            self.by_merges = Tokenizer.from_str(self.a_json)
            self.by_merges.encode_special_tokens = True
        return np.array(self.by_merges.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """List columns of both sides' ids, empty where the joined bytes of either aren't those of a space and the text."""
        a = [self.encode_a(" " + t) if t else np.zeros(0, np.uint32) for t in texts]
        b = [np.array(x, np.int32) for x in self.b.encode(texts, num_threads=1)]
        good = np.ones(len(texts), bool)
        for ids, spelling in ((a, self.a_spelling), (b, self.b_spelling)):
            n = np.r_[0, np.cumsum([len(x) for x in ids])]
            flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int64)
            joined, upto = spelling.spell(flat), np.r_[0, spelling.size[flat].cumsum()][n]
            good &= [joined[x:y].tobytes() == b" " + t.encode() for t, x, y in zip(texts, upto[:-1], upto[1:], strict=True)]
        return _lists(a, good), _lists(b, good)


#: Fixed value: how the byte-level vocabulary's library splits a text before its merges.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _lists(ids: list[np.ndarray], good: np.ndarray) -> pa.ListArray:
    ids = [x if ok else x[:0] for x, ok in zip(ids, good, strict=True)]
    off = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)))


_READY: dict[str, Tokenizers] = {}


def worker_tokenizers(a_json: str, b_model: bytes) -> Tokenizers:
    """One pair of tokenizers for each Python worker."""
    key = hashlib.sha256(a_json.encode() + b_model).hexdigest()
    if key not in _READY:
        _READY.clear()
        _READY[key] = Tokenizers(a_json, b_model)
    return _READY[key]


def _tokens(ids: pa.ListArray, size: np.ndarray, side: str) -> pa.Table:
    """One row per token: its document and end there as one key, and its place among all tokens."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids).to_numpy().astype(np.int64)
    run = pc.cumulative_sum(pa.array(size[flat.to_numpy()], pa.int64())).to_numpy()
    # what had run up before the document's first token is taken off
    n = pc.list_value_length(ids).to_numpy().astype(np.int64)
    before = np.r_[0, run][n.cumsum() - n]
    return pa.table({"key": doc << END_BITS | run - before[doc], side: np.arange(len(flat), dtype=np.int64)})


def align(a_ids: pa.ListArray, b_ids: pa.ListArray, a_size: np.ndarray, b_size: np.ndarray) -> pa.Table:
    """One row per link in text order: doc, a and b (places of the tokens among all), both (A and B end here)."""
    a, b = _tokens(a_ids, a_size, "a"), _tokens(b_ids, b_size, "b")
    met = a.join(b, "key", join_type="full outer", use_threads=False).combine_chunks()
    met = met.take(pa.array(np.argsort(met["key"].to_numpy(), kind="stable")))
    both = pc.and_(pc.is_valid(met["a"]), pc.is_valid(met["b"]))
    # at an end of one side the other side's token is the next to end
    return pa.table({"doc": met["key"].to_numpy() >> END_BITS, "a": pc.fill_null_backward(met["a"]), "b": pc.fill_null_backward(met["b"]), "both": both})


def group_digests(a_ids: pa.Array, b_ids: pa.Array, links: pa.Table) -> list[str]:
    """For each document the digest of ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    n_docs = len(a_ids)
    a, b = pc.list_flatten(a_ids), pc.list_flatten(b_ids)
    ends = links.filter(links["both"])
    last_a, last_b = ends["a"].to_numpy(), ends["b"].to_numpy()
    # A's tokens of a group, then B's: a token moves on by the other side's tokens that come before its group or in it
    group_a = np.searchsorted(last_a, np.arange(len(a)))
    group_b = np.searchsorted(last_b, np.arange(len(b)))
    at_a = np.arange(len(a)) + np.r_[0, last_b + 1][group_a]
    at_b = np.arange(len(b)) + (last_a + 1)[group_b] if len(b) else np.zeros(0, np.int64)
    ids, mark = np.empty(len(a) + len(b), np.int32), np.zeros(len(a) + len(b), np.int8)
    ids[at_a], ids[at_b] = a.to_numpy(), b.to_numpy()
    mark[at_a[last_a]], mark[at_b[last_b]] = 1, 2
    marks = pa.DictionaryArray.from_arrays(pa.array(mark), pa.array([",", "|", ";"])).cast(pa.string())
    text = pc.binary_join_element_wise(pc.cast(pa.array(ids), pa.string()), marks, "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    off = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1)
    data = memoryview(text.buffers()[2]) if len(text) else memoryview(b"")
    n = (pc.list_value_length(a_ids).to_numpy().astype(np.int64) + pc.list_value_length(b_ids).to_numpy())
    upto = np.r_[0, n.cumsum()]
    return [hashlib.sha256(data[off[upto[i]]:off[upto[i + 1]] - 1]).hexdigest() if n[i] else "" for i in range(n_docs)]


_BLOCKS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "codes binary, pairs array<long>, counts array<long>")


_BLOCK_SCHEMA = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("codes", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def _aligned(part: pa.RecordBatch, both: Tokenizers) -> tuple[list[pa.Array], np.ndarray]:
    """n_a, n_b, n_groups, n_links, digest of each row, and the id pair of every link in order."""
    a_ids, b_ids = both.encode(pc.fill_null(part.column("text"), "").to_pylist())
    links = align(a_ids, b_ids, both.a_spelling.size, both.b_spelling.size)
    a, b = pc.list_flatten(a_ids).to_numpy().astype(np.int64), pc.list_flatten(b_ids).to_numpy().astype(np.int64)
    doc, n = links["doc"].to_numpy(), part.num_rows
    rows = [pc.list_value_length(a_ids), pc.list_value_length(b_ids), pa.array(np.bincount(doc[links["both"].to_numpy()], minlength=n)),
            pa.array(np.bincount(doc, minlength=n)), pa.array(group_digests(a_ids, b_ids, links), pa.string())]
    return rows, a[links["a"].to_numpy()] << B_BITS | b[links["b"].to_numpy()]


def _block_rows(part: pa.RecordBatch, block: int, both: Tokenizers) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """The rows of a block's documents, and the one row of its distinct pairs with their counts."""
    done = [_aligned(piece, both) for piece in text_slices(iter([part]), PIECE_BYTES)]
    pair = pa.array(np.concatenate([p for _, p in done]))
    counted = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).combine_chunks()
    # a document's links, as places in the block's list of pairs
    codes = pc.index_in(pair, counted["pair"].combine_chunks()).to_numpy().astype(np.int32)
    columns = [pa.concat_arrays([rows[i].cast(_BLOCK_SCHEMA.field(i + 2).type) for rows, _ in done]) for i in range(5)]
    at, n = np.r_[0, columns[3].to_numpy().cumsum()], part.num_rows
    codes = pa.array([codes[at[i]:at[i + 1]].tobytes() for i in range(n)], pa.binary())
    rows = [pa.array([block] * n, pa.int64()), part.column("doc_id"), *columns, codes, *(pa.nulls(n, f.type) for f in list(_BLOCK_SCHEMA)[-2:])]
    lists = {"block": [block], "pairs": [counted["pair"].to_numpy()], "counts": [counted["count_all"].to_numpy()]}
    listed = [pa.array(lists.get(f.name, [None]), f.type) for f in _BLOCK_SCHEMA]
    return pa.RecordBatch.from_arrays(rows, schema=_BLOCK_SCHEMA), pa.RecordBatch.from_arrays(listed, schema=_BLOCK_SCHEMA)


def blocks(docs: DataFrame, a_json: str, b_model: bytes) -> DataFrame:
    """One row per row of ``docs``, and one row per block of rows with its pairs; the latter have ``pairs``."""
    shared = docs.sparkSession.sparkContext.broadcast((a_json, b_model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_tokenizers(*shared.value)
        task = TaskContext.get().partitionId()
        for number, part in enumerate(text_slices(batches, BLOCK_BYTES)):
            yield from _block_rows(part, task << 40 | number, both)

    return id_text(docs).mapInArrow(run, _BLOCKS)


def pair_counts(made: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair over the corpus, and whether no pair of its B id has more."""
    each = made.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counts = stored(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")), "align-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    top = stored(counts.groupBy(b.alias("b")).agg(F.max("n").alias("most")), "align-top")
    return counts.join(top, b == top.b).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level vocabulary of the tokenizers library, given a space and the
    text, B a sentencepiece model, given the text; neither reads special tokens in
    a text. Null and empty texts, and texts whose tokens don't spell out a space and
    the text, have no tokens: zeros and ''. They take no part in the counts. Rows with
    null or repeated ids are rows of their own, and no columns but the two are read.
    A long text is a block of its own, however long. The vocabulary files have a
    fixed size; they are read once on the driver and broadcast.
    """
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    made = stored(blocks(docs, a_json, b_model), "align-blocks")
    counts = stored(pair_counts(made), "align-pairs")
    listed = made.where("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("at", "pair"))
    known = listed.join(counts, "pair").select(F.col("block").alias("of"), "at", "n", "best")
    rows = made.where("pairs IS NULL").drop("pairs", "counts")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right["at"].to_numpy()
        n[at], best[at] = right["n"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        codes = [np.frombuffer(c.as_buffer(), np.int32) for c in left["codes"]]
        sums = [(int(best[c].sum()), int(n[c].sum())) for c in codes]
        out = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array([s[0] for s in sums], pa.int64()))
        out = out.append_column("count_sum", pa.array([s[1] for s in sums], pa.int64()))
        return out.append_column("groups_sha256", left["groups_sha256"])

    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        add_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
