"""Removal of repeated byte strings by suffix sorting in shards bounded to memory.

A byte goes when a string of 400 bytes covers it that also starts anywhere else.

Candidates. Each window of 400 bytes has a minimiser, its 32-byte string of
smallest hash: equal windows have equal minimisers at equal offsets. Windows
in a row that share a minimiser form a run; a minimiser that occurs in one run only
rules the whole run out. Runs that are left are cut into bands of windows by
offset. The windows of a band share a core, so equal windows lie in bands with
equal cores. Bands with equal bytes are folded into one with a count.

Decision. Bands with equal cores and different edges go into shards. In a shard, a
core becomes one symbol between the bytes of its edges, and the suffixes of all
bands are sorted by recursive induction with disk-backed queues
(``induced_sort``): a window is repeated when it shares its whole length with a
neighbour. A core with very many different bands is first split into
finer bands, down to single windows, so that no shard depends on one core; single
windows are decided by folding alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import SLICE_BYTES, located, stored, text_bytes, text_slices, utf8
from contrail.llm.induced_sort import suffixes

LENGTH, GRAM = 400, 32
#: Window starts of a band, at each step of splitting.
WIDTHS = (64, 8, 1)
#: Different bands of one core that are sorted without splitting, and bands of a shard.
LARGE_CORE, SHARD_BANDS = 2048, 8192
_U64 = np.uint64
_B = 0x9E3779B97F4A7C15 | 1


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position on."""
    h, b = data.astype(_U64) + _U64(1), _B
    for step in (1, 2, 4, 8, 16):
        h = h[:-step] * _U64(b) + h[step:]
        b = b * b & 0xFFFFFFFFFFFFFFFF
    h ^= h >> _U64(29)
    h *= _U64(0xBF58476D1CE4E5B9)
    h ^= h >> _U64(32)
    return h


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every i that has w values."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def minimiser_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, key, anchor, first, last) of all runs: windows first..last of the text share the minimiser at ``anchor``."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none
    h = gram_hashes(data)
    # 40 bits of hash, then the place (a stretch of text is far shorter than 2^24 bytes): ties go to the left
    best = window_minima((h >> _U64(24) << _U64(24)) | np.arange(len(h), dtype=_U64), LENGTH - GRAM + 1)
    anchor = (best & _U64((1 << 24) - 1)).astype(np.int64)
    at = np.arange(len(anchor))
    text = np.searchsorted(off, at, side="right") - 1
    ok = np.flatnonzero(at + LENGTH <= off[text + 1])
    if not len(ok):
        return none, none, none, none, none
    text, anchor = text[ok], anchor[ok]
    new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])])
    last = np.r_[new[1:], len(ok)] - 1
    t = text[new]
    base = off[t]
    return t, h[anchor[new]].view(np.int64), anchor[new] - base, ok[new] - base, ok[last] - base


def _stretches(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, position in the text): a slice of texts, or a very long text in overlapping stretches."""
    if len(off) > 2 or len(data) <= 2 * SLICE_BYTES:
        yield data, off, 0
        return
    for at in range(0, len(data) - LENGTH + 1, SLICE_BYTES):
        piece = data[at:at + SLICE_BYTES + LENGTH - 1]
        yield piece, np.array([0, len(piece)]), at


_RUN = pa.struct([("key", pa.int64()), ("anchor", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])


def text_runs(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, file, row, n_bytes, sha256 of the whole text, runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            data, off = utf8(part.column("text"))
            found = []
            for piece, offsets, at in _stretches(data, off):
                t, key, *places = minimiser_runs(piece, offsets)
                found.append((t, key, *(p + at for p in places)))
            t, key, anchor, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
            fields = [pa.array(key, pa.int64()), *(pa.array(p.astype(np.int32)) for p in (anchor, first, last))]
            runs = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(t, np.arange(part.num_rows + 1)).astype(np.int32)), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
            sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("file"), part.column("row"), pa.array(np.diff(off)), pa.array(sha, pa.string()), runs],
                ["doc_id", "file", "row", "n_bytes", "sha256", "runs"])
    return docs.mapInArrow(
        run, "doc_id long, file long, row long, n_bytes long, sha256 string, runs array<struct<key:long,anchor:int,first:int,last:int>>")


def cut_bands(text: bytes, start: int, high: int, low: int, width: int) -> Iterator[tuple[int, bytes, int, int, bytes]]:
    """(core, bytes id, start, highest offset, bytes) of the bands of windows with offsets high..low; the first is at ``start``."""
    o = high
    while o >= low:
        base = o // width * width
        end = max(base, low)
        at = start + high - o
        raw = text[at:at + o - end + LENGTH]
        core = raw[o - base:o - base + LENGTH - width + 1]
        yield xxhash.xxh3_64_intdigest(core, base) - (1 << 63), xxhash.xxh3_128_digest(raw, o * LENGTH + end), at, o, raw
        o = end - 1


_BAND = [("core", pa.int64()), ("id", pa.binary()), ("file", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("high", pa.int32()), ("n", pa.int32())]
_BAND_SQL = "core long, id binary, file long, row long, start int, high int, n int"


def first_bands(texts: DataFrame) -> DataFrame:
    """Bands of the candidate runs of (file, row, text, runs), without their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            out: list[tuple] = []
            for file, row, text, runs in zip(
                    part.column("file").to_pylist(), part.column("row").to_pylist(), text_bytes(part.column("text")), part.column("runs").to_pylist(), strict=True):
                for r in runs:
                    for core, key, at, high, raw in cut_bands(text, r["first"], r["anchor"] - r["first"], r["anchor"] - r["last"], WIDTHS[0]):
                        out.append((core, key, file, row, at, high, len(raw) - LENGTH + 1))
            yield _record(out, _BAND)
    return texts.mapInArrow(run, _BAND_SQL)


def _record(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def split_bands(bands: DataFrame, width: int) -> DataFrame:
    """The same windows in finer bands; ``bands`` and the result carry bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out = []
            for b in part.to_pylist():
                for core, key, at, high, raw in cut_bands(b["bytes"], 0, b["high"], b["high"] - b["n"] + 1, width):
                    out.append((core, key, b["file"], b["row"], b["start"] + at, high, len(raw) - LENGTH + 1, raw))
            yield _record(out, [*_BAND, ("bytes", pa.binary())])
    return bands.mapInArrow(run, _BAND_SQL + ", bytes binary")


def fold_bands(bands: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(repeated, open): where bands stand whose bytes occur twice, and one band for each kind of bytes
    of cores that have several kinds, one of them at least standing alone; ``kinds`` is their number."""
    rest = [c for c in bands.columns if c not in ("core", "id")]
    kinds = stored(
        bands.groupBy("core", "id").agg(F.count(F.lit(1)).alias("times"), *(F.first(c).alias(c) for c in rest)), f"{name}-kinds")
    twice = stored(kinds.where("times > 1").select("core", "id"), f"{name}-twice")
    repeated = bands.join(twice, ["core", "id"]).select("file", "row", "start", (F.col("start") + F.col("n") + LENGTH - 1).alias("end"))
    cores = stored(
        kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("times").alias("least")).where("kinds > 1 AND least = 1").select("core", "kinds"),
        f"{name}-cores")
    return repeated, kinds.join(cores, "core")


def shared_edges(edges: list[bytes], core: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each band the most bytes, from the core outwards, that its edge shares with the edge of another band of
    its core, and the bytes that all edges of its core share."""
    sizes = np.fromiter(map(len, edges), np.int64, len(edges))
    cells = np.zeros((len(edges), int(sizes.max(initial=0))), np.uint16)  # 0 is past the end
    cells[np.arange(cells.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(edges), np.uint8).astype(np.uint16) + 1
    order = np.lexsort((*cells.T[::-1], core))
    cells, core = cells[order], core[order]
    differ = np.c_[(cells[1:] != cells[:-1]) | (cells[1:] == 0), np.ones(len(cells) - 1, bool)]
    common = np.r_[0, differ.argmax(axis=1), 0]  # with the edge before, in order
    first = np.r_[True, core[1:] != core[:-1]]
    common[np.flatnonzero(np.r_[first, True])] = 0
    most, least = np.empty(len(edges), np.int64), np.empty(len(edges), np.int64)
    most[order] = np.maximum(common[:-1], common[1:])
    starts = np.flatnonzero(first)
    of_core = np.minimum.reduceat(np.where(first, np.iinfo(np.int64).max, common[:-1]), starts)
    least[order] = np.repeat(of_core, np.diff(np.r_[starts, len(edges)]))
    return most, np.minimum(least, most)


def repeated_windows(bands: list[dict], width: int) -> list[tuple[int, int, int, int]]:
    """(file, row, start, end) of stretches of repeated windows, by sorting the suffixes of all bands of a shard.

    What all bands of a core share next to it joins its symbol, and what a band shares with no other
    band of its core is left out, with the windows that reach there: they stand once.
    """
    if not bands:
        return []
    cores: dict[int, int] = {}
    of = np.array([cores.setdefault(b["core"], len(cores)) for b in bands])
    middle = LENGTH - width + 1
    lead = np.array([b["high"] % width for b in bands])
    left, left_all = shared_edges([b["bytes"][:k][::-1] for b, k in zip(bands, lead.tolist(), strict=True)], of)
    right, right_all = shared_edges([b["bytes"][k + middle:] for b, k in zip(bands, lead.tolist(), strict=True)], of)
    # a window that reads ``a`` bytes of the left edge reads width - 1 - a of the right one
    most = np.minimum(lead, left)
    least = np.maximum(lead + 1 - np.array([b["n"] for b in bands]), width - 1 - right)
    symbols: list[int] = []
    owner, places, reads, need = [], [], [], []
    for k in np.flatnonzero(least <= most).tolist():
        raw, at, hi, lo, d, c = bands[k]["bytes"], int(lead[k]), int(most[k]), int(least[k]), int(left_all[k]), int(right_all[k])
        ahead = max(0, hi - d)
        end = at + middle + max(c, width - 1 - lo)
        for a in range(hi, lo - 1, -1):
            owner.append(k)
            reads.append(a)
            places.append(len(symbols) + min(hi - a, ahead))
            need.append(max(0, a - d) + 1 + max(0, width - 1 - a - c))
        symbols += [x + 2 for x in raw[at - hi:at - hi + ahead]]
        symbols.append(258 + int(of[k]))
        symbols += [x + 2 for x in raw[at + middle + c:end]]
        symbols.append(1)
    # close the numbering of cores up to the symbols in use
    _, dense = np.unique(np.array(symbols, np.int64), return_inverse=True)
    best, before = [0] * len(symbols), None
    for p, shared in suffixes(dense + 1):
        if shared > best[p]:
            best[p] = shared
        if before is not None and shared > best[before]:
            best[before] = shared
        before = p
    out: list[list[int]] = []
    for i in np.flatnonzero(np.array(best, np.int64)[places] >= need).tolist() if places else ():
        k = owner[i]
        b = bands[k]
        at = b["start"] + int(lead[k]) - reads[i]
        if b["times"] == 1:
            if out and out[-1][:2] == [b["file"], b["row"]] and out[-1][4] == k and out[-1][3] == at + LENGTH - 1:
                out[-1][3] = at + LENGTH
            else:
                out.append([b["file"], b["row"], at, at + LENGTH, k])
    return [tuple(x[:4]) for x in out]


_SPAN_SQL = "file long, row long, start int, end int"


def sort_shards(bands: DataFrame, width: int) -> DataFrame:
    """Repeated stretches among the open bands, whole cores to a shard."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        spans = repeated_windows(rows.to_pylist(), width)
        return pa.Table.from_batches([_record(spans, [("file", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])])
    shards = max(1, bands.count() // SHARD_BANDS)
    return bands.withColumn("shard", F.pmod(F.xxhash64("core"), F.lit(shards))).groupBy("shard").applyInArrow(run, _SPAN_SQL)


def band_bytes(bands: DataFrame, texts: DataFrame) -> DataFrame:
    """The bands with their bytes, cut out of (file, row, text)."""
    fields = ["core", "id", "start", "high", "n", "times", "kinds"]
    wanted = bands.groupBy("file", "row").agg(F.collect_list(F.struct(*fields)).alias("bands"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            out = []
            for file, row, text, mine in zip(
                    part.column("file").to_pylist(), part.column("row").to_pylist(), text_bytes(part.column("text")), part.column("bands").to_pylist(), strict=True):
                out += [(*(b[f] for f in fields), file, row, text[b["start"]:b["start"] + b["n"] + LENGTH - 1]) for b in mine]
            types = dict(_BAND) | {"times": pa.int64(), "kinds": pa.int64(), "bytes": pa.binary()}
            yield _record(out, [(f, types[f]) for f in (*fields, "file", "row", "bytes")])
    joined = texts.select("file", "row", "text").join(wanted, ["file", "row"])
    return joined.mapInArrow(run, "core long, id binary, start int, high int, n int, times long, kinds long, file long, row long, bytes binary")


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes removed, maximal removed stretches, and sha256 of what is left."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    ends = [0, *(b for _, b in merged)]
    kept = b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in merged), len(text)], strict=True))
    return sum(b - a for a, b in merged), len(merged), hashlib.sha256(kept).hexdigest()


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(file, row, start, end), in parts that may overlap, from candidate texts (file, row, text, runs)."""
    bands = stored(first_bands(texts), "suffix-bands")
    spans, open_ = fold_bands(bands, "suffix-0")
    open_ = stored(band_bytes(open_, texts), "suffix-open-0")
    found = [spans]
    for k, width in enumerate(WIDTHS):
        if k + 1 < len(WIDTHS):
            found.append(sort_shards(open_.where(F.col("kinds") <= LARGE_CORE), width))
            large = open_.where(F.col("kinds") > LARGE_CORE)
            if large.isEmpty():
                break
            finer = stored(split_bands(large, WIDTHS[k + 1]), f"suffix-bands-{k + 1}")
            spans, open_ = fold_bands(finer, f"suffix-{k + 1}")
            open_ = stored(open_, f"suffix-open-{k + 1}")
            found.append(spans)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are taken as UTF-8 bytes, null as empty. Matches never cross texts, and
    strings are judged on the input. Repeated rows repeat each other, so all of
    their windows go; texts of fewer than 400 bytes lose nothing. Rows without an id
    are treated like any other.
    """
    at = located(docs)
    rows = stored(text_runs(at), "suffix-runs")
    runs = rows.select("file", "row", F.explode("runs").alias("r")).select("file", "row", "r.*")
    shared = stored(runs.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key"), "suffix-keys")
    wanted = runs.join(shared, "key").groupBy("file", "row").agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "anchor"))).alias("runs"))
    texts = stored(at.select("file", "row", "text").join(stored(wanted, "suffix-wanted"), ["file", "row"]), "suffix-texts")
    spans = repeated_spans(texts).groupBy("file", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            out = [
                (file, row, *cut_out(text, [(s["start"], s["end"]) for s in mine]))
                for file, row, text, mine in zip(
                    part.column("file").to_pylist(), part.column("row").to_pylist(), text_bytes(part.column("text")), part.column("spans").to_pylist(), strict=True)
            ]
            yield _record(out, [("file", pa.int64()), ("row", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string())])
    cut = texts.select("file", "row", "text").join(stored(spans, "suffix-spans"), ["file", "row"]).mapInArrow(
        run, "file long, row long, n_removed long, n_spans long, kept string")
    none = F.lit(0).cast("long")
    return rows.join(cut, ["file", "row"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept", "sha256").alias("kept_sha256"))
