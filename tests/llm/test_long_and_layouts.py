"""Wrapped and escaped keys, personal data in long texts, page layouts that hide article parts from careless rules."""

import base64
import random
import time

import pytest

from contrail.llm import host_paths, pii_bootstrap, secret_scan
from tests.llm.helpers import docs_frame
from tests.llm.test_text_operators import KEY, rsa_key

# ---- secrets -------------------------------------------------------------------

WRAPPED = [KEY[i:i + 64] for i in range(0, len(KEY), 64)]
ARMOUR = "-----BEGIN RSA PRIVATE KEY-----{0}-----END RSA PRIVATE KEY-----"
SEALED = base64.b64encode(random.Random(5).randbytes(320)).decode()
HEADERS = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: {0}\n\n"


def _kinds(text):
    return [(k, text[a:b]) for k, a, b in secret_scan.confirmed_spans(text)]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n", "\n    "])
def test_armoured_and_wrapped_keys_with_any_line_end(end):
    pem = ARMOUR.format(end + end.join(WRAPPED) + end)
    assert _kinds(f'{{"key": "{pem}"}}') == [("pem", pem)]
    bare = end.join(WRAPPED)
    for before, after in (("", ""), ("é key:\n", "\n"), ("x ", end + "the words that follow it"), ("", end)):
        assert _kinds(before + bare + after) == [("key", bare)], (before, after)


def test_armoured_keys_with_headers():
    plain = ARMOUR.format("\nComment: made\n by hand\n\n" + "\n".join(WRAPPED) + "\n")
    sealed = ARMOUR.format(HEADERS.format("AES-128-CBC," + "0A" * 16) + SEALED + "\n")
    escaped = sealed.replace("\n", "\\n")
    assert [_kinds(t) for t in (plain, sealed, escaped)] == [[("pem", t)] for t in (plain, sealed, escaped)]
    for dek in ("AES-128-CBC,0A", "ROT13,0A0A0A0A0A0A0A0A", "", "DES-EDE3-CBC,XY" + "0" * 14):
        assert _kinds(ARMOUR.format(HEADERS.format(dek) + SEALED + "\n")) == []
    assert _kinds(ARMOUR.format(HEADERS.format("DES-EDE3-CBC," + "0A" * 8) + SEALED[:-8] + "\n")) == []         # no whole blocks


def test_lookalikes_are_no_keys():
    cut = WRAPPED[:-2]
    noise = base64.b64encode(random.Random(3).randbytes(500)).decode()
    for text in ("\n".join(cut), "\\n".join(noise[i:i + 64] for i in range(0, len(noise), 64)), ARMOUR.format("\n" + noise + "\n"),
                 ARMOUR.format("\n\n"), ARMOUR.format("no key, only words - with a dash\n"), "-----BEGIN PRIVATE KEY-----" * 50):
        assert _kinds(text) == []


def test_secret_scan_of_a_long_text(spark):
    """Past the slice of 2 MB, with keys at its ends, and in time that follows its length."""
    pem = ARMOUR.format("\\n" + "\\n".join(WRAPPED) + "\\n")
    text = pem + " word" * 500_000 + ("A" * 70 + "\n") * 20_000 + " " + rsa_key().hex() + "-----BEGIN PRIVATE KEY-----" * 2000
    began = time.monotonic()
    row = secret_scan.scan_secrets(docs_frame(spark, [(1, text), (2, None)])).where("doc_id = 1").first()
    assert row.n_confirmed == 2 and f"pem:0:{len(pem)}" in row.spans.split(",") and time.monotonic() - began < 60


# ---- personal data ---------------------------------------------------------------

def _scan(spark, texts):
    rows = pii_bootstrap.scan(docs_frame(spark, list(enumerate(texts)))).collect()
    return {r.doc_id: r for r in rows}


def test_places_over_many_blocks_and_pieces(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(12):
        words = [rng.choice(["é日本", "word", "a@b.cd", "10.0.0.1", "+49 30 1234567", "😀", "x9", "\n", "w" * rng.randrange(1, 700)])
                 for _ in range(rng.randrange(0, 900))]
        texts.append(" ".join(words))
    for i, r in _scan(spark, texts).items():
        t = texts[i]
        for kind in pii_bootstrap.KINDS:
            assert all(t[m.start:m.end] == m.found for m in r[kind])
        assert len(r.email) == t.count("a@b.cd") and len(r.ip) == t.count("10.0.0.1")
        ends = [m.start for m in r.instances]
        assert ends == sorted(ends) and (not r.instances or len(ends) == len(set(ends)))
        for m in r.instances:
            assert t[m.start:m.end] == m.found
            assert m.left == t[max(m.start - 64, 0):m.start] and m.right == t[m.end:m.end + 64]


def test_time_follows_the_length_of_one_text(spark):
    def seconds(n):
        df = pii_bootstrap.scan(docs_frame(spark, [(1, " ".join(f"w{i}x num {i}" for i in range(n)))]))
        began = time.monotonic()
        df.write.format("noop").mode("overwrite").save()
        return time.monotonic() - began
    seconds(2000)
    few = min(seconds(20_000) for _ in range(2))
    assert min(seconds(40_000) for _ in range(2)) <= 2.5 * few + 0.3


def test_added_spans_keep_clear_of_base_spans(spark):
    rng = random.Random(4)
    cut = sorted(rng.sample(range(20_000), 1600))
    base = [(a, 1 + i % 4, b) for i, (a, b) in enumerate(zip(cut[::2], cut[1::2], strict=True))]
    extra = [(a, 4, a + rng.randrange(1, 40)) for a in rng.sample(range(20_000), 300)]
    span = "array<struct<start:int,kind:int,end:int>>"
    shuffled = rng.sample(base, len(base))
    df = spark.createDataFrame([(shuffled, extra), ([], extra), (base, [])], f"base {span}, added {span}")
    from pyspark.sql import functions as F
    got = [[tuple(s) for s in r[0]] for r in df.select(pii_bootstrap._clear_of(F.col("added"), F.col("base"))).collect()]
    want = [s for s in extra if not any(b[0] < s[2] and s[0] < b[2] for b in base)]
    assert got == [want, extra, []] and 0 < len(want) < len(extra)


# ---- pages -----------------------------------------------------------------------

P = "This paragraph has running text of the article and it goes on for well over eighty characters, part {0}."
INSIDE = [                                              # (html inside the article, blocks it must give)
    ("<section class='related-work'><h2>Work</h2><p>{0}</p></section>", ["Work", P.format(1)]),
    ("<section class='search-methods'><p>{0}</p></section>", [P.format(1)]),
    ("<section id='comments-on-law'><p>{0}</p><p>{0}</p></section>", [P.format(1), P.format(1)]),
    ("<div class='banner-of-history'><ul><li>{0}</li></ul></div>", [P.format(1)]),
    ("<div class='ad-hominem'><div><blockquote>{0}</blockquote></div></div>", [P.format(1)]),
    ("<p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>mc^2</annotation></math>, he wrote.</p>", ["E = mc2, he wrote."]),
    ("<section class='related'><p>{0}</p></section>", []),
    ("<div class='comments-section'><div class='comment'><p>{0}</p></div></div>", []),
    ("<div class='comment-37 user-comments'><p>{0}</p></div>", []),
    ("<div class='newsletter-signup'><p>{0}</p></div>", []),
    ("<div class='ad-300x250'><p>Buy now</p></div>", []),
    ("<div class='promo-xyz'><p><a href=/a>{0}</a></p></div>", []),
    ("<div class='related-stuff'><ul><li><a href=/b>Other</a></li><li>short</li></ul></div>", []),
    ("<div class='share-buttons'>Share</div>", []),
    ("<aside><p>{0}</p></aside>", []),
    ("<div hidden><p>{0}</p></div>", []),
]


@pytest.mark.parametrize(("inner", "want"), INSIDE)
@pytest.mark.parametrize("holder", ["<article>{0}</article>", "<main><div class=content>{0}</div></main>"])
def test_only_what_is_no_article_goes(inner, want, holder):
    body = "<h1>Head</h1><p>" + P.format(0) + "</p>" + inner.format(P.format(1)) + "<p>" + P.format(2) + "</p>"
    page = f"<html><body><nav>Menu</nav>{holder.format(body)}<footer>End</footer></body></html>"
    expected = "\n".join(["Head", P.format(0), *want, P.format(2)])
    for path in (None, *(v[0] for v in host_paths.votes(page)), "/html/body/div.elsewhere"):
        assert host_paths.main_text(page, path) == expected


def test_host_path_that_holds_a_part_is_climbed():
    """The host votes for one box; this page goes on in a second one beside it."""
    first, more = "First words of it. " * 17, "More words that follow. " * 42
    page = f"<html><body><div class=wrap><div class=post><p>{first}</p></div><div class=post-more><p>{more}</p></div></div></body></html>"
    whole = f"{first.strip()}\n{more.strip()}"
    for path in (None, "/html/body/div.wrap/div.post", "/html/body/div.wrap/div.post-more", "/html/body/div.wrap"):
        assert host_paths.main_text(page, path) == whole


def test_pages_past_a_slice_with_repeats_and_nulls(spark):
    big = "<html><body><article>" + "".join(f"<p>{P.format(i)}</p>" for i in range(25_000)) + "</article></body></html>"
    small = f"<html><body><article><p>{P.format(0)}</p></article></body></html>"
    rows = [(1, "https://a.example/1", big), (None, "https://a.example/2", small), (None, None, small), (3, "https://a.example/1", small),
            (3, "https://a.example/1", small), (4, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id or -1, r.url or "", r.n_chars) for r in host_paths.extract_main_text(pages).collect())
    n = len(P.format(0))
    assert got == sorted([(1, rows[0][1], sum(len(P.format(i)) + 1 for i in range(25_000)) - 1), (-1, rows[1][1], n), (-1, "", n),
                          (3, rows[3][1], n), (3, rows[4][1], n), (4, "", 0)])
