"""Byte-level BPE through a sentencepiece BPE model built straight from a rank vocabulary.

The vocabulary (lines of ``base64(token) rank``) is serialised as a sentencepiece
model without any training: every byte is mapped to one code point, a token
becomes the piece of its mapped bytes, and its score is the negative rank, so
sentencepiece's best-scoring merge is the merge of lowest rank. Normalisation is
the identity. Texts are split into pre-tokens by the tokenizer's pattern, each
distinct pre-token is encoded once while a task remembers it, and the ids are decoded again by the
inverse byte mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from contrail.llm.common import id_text, text_slices

#: Byte b is the code point FIRST + b: letters only, so nothing counts as white space.
FIRST = 0x100
BYTE_MAP = {b: chr(FIRST + b) for b in range(256)}
#: Distinct pre-tokens a task remembers before it starts again, and the longest remembered.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, varint or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece ModelProto; piece ids equal ranks, which must be 0..n-1."""
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte-level vocabulary holds every single byte")
    pieces = [
        _field(1, _field(1, to_piece(t).encode()) + _field(2, -float(r)) + _field(3, 1))
        for r, t in enumerate(by_rank)
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    n = len(pieces)
    # model type BPE, vocabulary size, id of <unk>; no begin, end or padding piece (-1)
    none = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, n) + _field(40, n - 1) + b"".join(_field(i, none) for i in (41, 42, 43))
    # identity: no dummy prefix, no white-space removal, no white-space escape
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


def to_piece(token: bytes) -> str:
    return token.decode("latin-1").translate(BYTE_MAP)


class Coder:
    """Encodes texts to ids and ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.token = {str(r): t for t, r in ranks.items()}
        self.known: dict[str, str] = {}

    def _learn(self, words: set[str]) -> None:
        """Make ``known`` hold the ids of every pre-token, as decimals joined by one space."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        raw = [w.encode() for w in new]
        # a pre-token that is a token as a whole needs no merges
        whole = [i for i, b in enumerate(raw) if b in self.ranks]
        self.known.update((new[i], str(self.ranks[raw[i]])) for i in whole)
        rest = [i for i, b in enumerate(raw) if b not in self.ranks]
        if rest:
            ids = self.sp.encode([to_piece(raw[i]) for i in rest], num_threads=1)
            self.known.update((new[i], " ".join(map(str, x))) for i, x in zip(rest, ids, strict=True))

    def encode(self, texts: list[str]) -> Iterator[tuple[str, int]]:
        """For each text its ids as decimals joined by one space, and their number."""
        parts = [self.split(t) for t in texts]
        words = set().union(*parts) if parts else set()
        self._learn(words)
        for found in parts:
            joined = " ".join(map(self.known.__getitem__, found))
            yield joined, joined.count(" ") + 1 if joined else 0
        for w in words:
            if len(w) > CACHE_CHARS:
                del self.known[w]

    def decode(self, ids: str) -> bytes:
        """Bytes of ids given as decimals joined by one space."""
        return b"".join(map(self.token.__getitem__, ids.split()))


#: One coder for each Python worker and vocabulary. Its pre-tokens go with the task: a worker that is kept for other stages has no use for them.
_CODERS: dict[str, Coder] = {}


def worker_coder(ranks: dict[bytes, int], model: bytes, pattern: str) -> Coder:
    key = hashlib.sha256(model + pattern.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(ranks, model, pattern)
    return _CODERS[key]


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``with_ids`` adds ``ids`` (array of int), for callers that want the tokens
    themselves. A null text counts as empty: no tokens and the digests of the
    empty string. Repeated rows and null ids give one row each; other columns are
    not read. The vocabulary file is read once on the driver (its size is fixed)
    and broadcast with the model built from it.
    """
    ranks = load_ranks(vocab_path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, serialise_model(ranks)))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(*shared.value, pattern)
        coder.known.clear()  # a task that failed leaves some
        for part in text_slices(batches):
            n, ids_sha, out_sha, ids = [], [], [], []
            for joined, count in coder.encode(pc.fill_null(part.column("text"), "").to_pylist()):
                n.append(count)
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                out_sha.append(hashlib.sha256(coder.decode(joined)).hexdigest())
                if with_ids:
                    ids.append([int(x) for x in joined.split()])
            cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
        coder.known.clear()

    return id_text(docs).mapInArrow(run, schema)
