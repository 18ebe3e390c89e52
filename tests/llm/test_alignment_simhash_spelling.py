"""Token alignment, SimHash blocks and the spelling trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from contrail.llm import simhash_blocks, spelling_trie, token_alignment
from contrail.llm.queries import alignment_files
from contrail.llm.simhash_blocks import fingerprint, simhash_duplicates
from contrail.llm.spelling_trie import spelling_variants
from contrail.llm.token_alignment import align_documents

from .helpers import EDGES, docs_frame, prose, with_clashes

LONG = [(70, "Long wörds repeat, here and there. " * 70_000), (71, "a" * 2_300_000)]
ODD = [(20, "<|endoftext|> <s> <unk> <0x41> ▁under ﬁ ligature nbsp"), (21, "日本語 🙂🙃 ́combining"), (22, " lead  and trail  "), (22, "twice the id"), (None, "no id")]


def align_brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    a_path, b_path = alignment_files()
    ta, tb = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    ta.encode_special_tokens = True
    letters = token_alignment.byte_letters()
    docs, links = [], Counter()
    for doc_id, t in rows:
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tb.encode(t) if t else []
        ab = [bytes(letters[c] for c in ta.id_to_token(i)) for i in a]
        bb = [bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, tb.id_to_piece(i)) for i in b)]
        if b"".join(ab) != b" " + (t or "").encode() or b"".join(bb) != b" " + (t or "").encode():
            a, b, ab, bb = [], [], [], []
        a_at = [i for i, x in enumerate(ab) for _ in x]
        b_at = [i for i, x in enumerate(bb) for _ in x]
        pairs = sorted(set(zip(a_at, b_at, strict=True)))
        links.update((a[i], b[j]) for i, j in pairs)
        ends = lambda x: np.cumsum([len(y) for y in x]).tolist()
        ea, eb, groups, x, y = ends(ab), ends(bb), [], 0, 0
        at = {e: i + 1 for i, e in enumerate(ea)}
        for j, e in enumerate(eb):
            if e in at:
                groups.append(",".join(map(str, a[x:at[e]])) + "|" + ",".join(map(str, b[y:j + 1])))
                x, y = at[e], j + 1
        docs.append((doc_id, len(a), len(b), groups, [(a[i], b[j]) for i, j in pairs]))
    most = defaultdict(int)
    for (_, b), n in links.items():
        most[b] = max(most[b], n)
    return Counter((i, n_a, n_b, len(g), len(p), sum(links[q] == most[q[1]] for q in p), sum(links[q] for q in p),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "") for i, n_a, n_b, g, p in docs)


def some_prose(seed, n=60):
    rng = random.Random(seed)
    return [(100 + i, prose(rng, rng.randint(0, 60)) + rng.choice(["", "\n\n\tx", " don't 1234567", "…"])) for i in range(n)]


@pytest.mark.parametrize("rows", [some_prose(1), EDGES + ODD, EDGES + EDGES, []])
def test_align_documents(spark, rows):
    got = align_documents(with_clashes(docs_frame(spark, rows)), *alignment_files()).collect()
    assert Counter(map(tuple, got)) == align_brute(rows)


def test_align_documents_over_many_blocks(spark, monkeypatch):
    rows = some_prose(2, 80)
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(token_alignment, "PIECE_BYTES", 500)
    got = align_documents(docs_frame(spark, rows).repartition(5), *alignment_files()).collect()
    assert Counter(map(tuple, got)) == align_brute(rows)


def test_align_long_texts(spark):
    rows = [LONG[0], (72, "Long wörds repeat, here and there. ")]
    got = align_documents(docs_frame(spark, rows), *alignment_files()).collect()
    assert Counter(map(tuple, got)) == align_brute(rows)


def test_ranks_encode_as_merges_do():
    """Every code point in places where the splitting pattern looks at its class, and runs on both sides of the switch."""
    from tokenizers import Tokenizer
    a_path, b_path = alignment_files()
    both = token_alignment.Tokenizers(open(a_path).read(), open(b_path, "rb").read())
    merges = Tokenizer.from_file(a_path)
    merges.encode_special_tokens = True
    assert both.by_ranks is not None
    texts = [" " + "".join(f"a{c}a1{c}1.{c}. {c}{c} x{c}\n" for c in map(chr, range(lo, lo + 256)))
             for lo in range(0, 0x110000, 256) if not 0xD800 <= lo < 0xE000]
    texts += [" " + x * n for x in ("a", " ", "é", "ab 1") for n in (1, token_alignment.LONG_RUN - 2, token_alignment.LONG_RUN + 5)]
    for t, e in zip(texts, merges.encode_batch(texts, add_special_tokens=False), strict=True):
        assert both.encode_a(t).tolist() == e.ids, hex(ord(t[2]))


def bits_brute(t):
    w = (t or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_brute(rows, bits=None):
    fp = [bits[i] if bits else bits_brute(t) for i, (_, t) in enumerate(rows)]
    ids = {}
    for (i, _), f in zip(rows, fp, strict=True):
        if i is not None:
            ids[f] = min(i, ids.get(f, i))
    root = {f: f for f in ids}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    all_ = sorted(ids)
    for x, f in enumerate(all_):
        for g in all_[:x]:
            if (f ^ g).bit_count() <= 3:
                root[find(f)] = find(g)
    smallest = {}
    for f, i in ids.items():
        smallest[find(f)] = min(i, smallest.get(find(f), i))
    return Counter((i, f"{f:016x}", smallest[find(f)] if i is not None else None) for (i, _), f in zip(rows, fp, strict=True))


def near_copies(seed):
    rng = random.Random(seed)
    rows = [(100 + i, prose(rng, rng.randint(1, 80))) for i in range(40)]
    base = prose(rng, 300).split()
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(50)}"
        rows.append((500 + i, " ".join(words)))
    rows += [(700 + i, rows[i][1].upper()) for i in range(0, 40, 4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [near_copies(1), EDGES + ODD + [(80, "TWO\x0bwords"), (81, "two words")], LONG, []])
def test_simhash_duplicates(spark, rows):
    got = simhash_duplicates(with_clashes(docs_frame(spark, rows))).collect()
    assert Counter(map(tuple, got)) == simhash_brute(rows)


@pytest.mark.parametrize(("crowd", "seed"), [(64, 1), (2, 2), (1, 3)])
def test_simhash_links_of_dense_clusters(spark, monkeypatch, crowd, seed):
    """Fingerprints around a few centres, and chains of three bits a step: crowded keys give the same components."""
    rng = random.Random(seed)
    bits = []
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << b
            bits.append(f)
    f = rng.getrandbits(64)
    for _ in range(20):
        for b in rng.sample(range(64), 3):
            f ^= 1 << b
        bits.append(f)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(1000 + i, None) for i in range(len(bits))]
    table = spark.createDataFrame([(i, signed(f)) for (i, _), f in zip(rows, bits, strict=True)], "doc_id long, fp long")
    monkeypatch.setattr(simhash_blocks, "CROWD", crowd)
    monkeypatch.setattr(simhash_blocks, "fingerprints", lambda _: table)
    got = simhash_duplicates(docs_frame(spark, [])).collect()
    assert Counter(map(tuple, got)) == simhash_brute(rows, bits)


def test_fingerprint_pieces(monkeypatch):
    text = prose(random.Random(5), 500)
    want = fingerprint(text.encode())
    monkeypatch.setattr(simhash_blocks, "PIECE", 7)
    assert fingerprint(text.encode()) == want and want & (1 << 64) - 1 == bits_brute(text)


def spelling_brute(rows):
    import re
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    holes = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k], w[k + 1:]].add(w)
    near = {w: {u for k in range(len(w)) for u in holes[w[:k], w[k + 1:]] if u != w} for w in n}
    for w in n:
        for u in {w[:k] + w[k + 1:] for k in range(len(w))} & n.keys():
            near[w].add(u)
            near[u].add(w)
    form = {}
    for w, us in near.items():
        best = min(us, key=lambda u: (-n[u], u), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = Counter()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root] += 1
    return out


def misspelt(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeïé") for _ in range(rng.randint(6, 9))) for _ in range(30)]
    rows = []
    for i in range(200):
        text = []
        for _ in range(150):
            w = words[min(int(rng.expovariate(0.3)), 29)]
            if rng.random() < 0.15:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + "b" + w[k:], w[:k] + "c" + w[k + 1:]])
            text.append(w.capitalize() if rng.random() < 0.2 else w)
        rows.append((i if i % 50 else None, " ".join(text)))
    return rows


@pytest.mark.parametrize("rows", [misspelt(1), EDGES + ODD + [(90, "Straße×÷ ÀÉÎÕÜ àéîõü naïveté×÷ abcdefgh abcdefgx abcdefg abcdefgh abcdefgx abcdefg")], LONG, []])
def test_spelling_variants(spark, rows):
    got = spelling_variants(with_clashes(docs_frame(spark, rows))).collect()
    assert Counter(map(tuple, got)) == spelling_brute(rows)


def test_spelling_variants_in_small_subtrees(spark, monkeypatch):
    """Subtrees cut deep and dealt into pieces give the same pairs."""
    monkeypatch.setattr(spelling_trie, "SUBTREE", 3)
    monkeypatch.setattr(spelling_trie, "SEARCHES", 5)
    monkeypatch.setattr(spelling_trie, "FRONTIER", 4)
    rows = misspelt(2)[:60]
    assert Counter(map(tuple, spelling_variants(docs_frame(spark, rows)).collect())) == spelling_brute(rows)


def test_spelling_chain(spark):
    """A form's own form is followed to the last."""
    words = ["abcdefgh"] * 400 + ["abcdefgx"] * 38 + ["abcdefyx"] * 3 + ["abcdefghh"] * 2
    rows = [(1 + i, w) for i, w in enumerate(words)]
    got = {r.word: r for r in spelling_variants(docs_frame(spark, rows)).collect()}
    assert Counter(tuple(r) for r in got.values()) == spelling_brute(rows)
    assert got["abcdefyx"].root == "abcdefgh"
