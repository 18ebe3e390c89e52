"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base findings (e-mail, IP, card, phone) come from patterns and seed the
bootstrap. Every identifier-like run of a text (words with a digit or an @) is an
instance; the words around it give its lexical patterns. Pattern and instance
scores are computed from each other over the pattern-instance graph: a pattern
is as good as the share of its instances believed to be of a kind, an instance
as good as its patterns together. Instances that no base pattern matches, that
have the rough shape of a kind and whose patterns are reliable for it, are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import id_text, stored

# Kinds in their order of listing, and the base patterns. Quantifiers are possessive and
# starts are anchored where that finds the same matches, so no text takes quadratic time.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth trying.
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
#: A run of words that holds an identifier: a word with a digit or @, then words of digits and signs.
INSTANCE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [0-9().+-]++(?!\S))*+"
#: Rough shape an added instance must have, by kind.
SHAPES = {
    "email": r"^[^\s@]+@[^\s@]+$",
    "ip": r"^(?:[0-9]{1,3}[.:-]){3,}[0-9]{1,3}$|^(?:[0-9a-f]{1,4}:){4,7}[0-9a-f]{1,4}$",
    "card": r"^[0-9]{4}(?:[ .-]?[0-9]{2,4}){2,4}$",
    "phone": r"^\(?[0-9]{2,4}\)?[ .-][0-9][0-9 .-]{4,11}[0-9]$",
}
#: Rounds of scoring, distinct seeds a pattern needs, share of believed instances, score for an addition.
ROUNDS, MIN_SEEDS, MIN_CONFIDENCE, MIN_SCORE = 3, 5, 0.8, 0.9
#: Characters of text looked at on either side of an instance.
CONTEXT = 64
#: Matches whose places are summed at a time, and characters of a piece of text (at least ``CONTEXT``).
BLOCK, PIECE = 128, 512


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    d = _digits(text)

    def doubled(i: Column) -> Column:
        v = F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, v).otherwise(2 * v - F.when(v > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), lambda s, i: s + doubled(i)) % 10 == 0


def is_valid(kind: str, text: Column) -> Column:
    """What a match must satisfy beyond its pattern."""
    n = F.length(_digits(text))
    if kind == "ip":
        parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.substring(p, 1, 3).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(text)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it inside its lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, found>>, in code points, ends exclusive.

    Positions are sums over the gaps and matches before: within blocks of ``BLOCK`` matches, then over the blocks, since
    appending to an array copies it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.split(text, pattern, -1), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))
    none = F.array().cast(_SPANS)

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.array_append(acc["spans"], F.struct(
            start.alias("start"), end.alias("end"), x["m"].alias("found"))).alias("spans"))

    def block(p: Column, j: Column) -> Column:
        size = F.least(F.lit(BLOCK), F.size(p) - 1 - j * BLOCK)
        return F.aggregate(F.slice(p, j * BLOCK + 1, size), F.struct(F.lit(0).alias("at"), none.alias("spans")), add)

    def placed(blocks: Column) -> Column:
        begins = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")), lambda acc, b: F.struct(
            (acc["at"] + b["at"]).alias("at"), F.array_append(acc["begins"], acc["at"]).alias("begins")))["begins"]
        return F.flatten(F.zip_with(blocks, begins, lambda b, o: F.transform(b["spans"], lambda s: F.struct(
            (s["start"] + o).alias("start"), (s["end"] + o).alias("end"), s["found"].alias("found")))))

    def spans(p: Column) -> Column:
        last = ((F.size(p) - 2) / BLOCK).cast("int")
        return F.when(F.size(p) < 2, none).otherwise(
            _bound(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda j: block(p, j)), placed))
    return _bound(pairs, spans)


_SPANS = "array<struct<start:int,end:int,found:string>>"


def base_matches(kind: str, text: Column) -> Column:
    sign = NEEDED.get(kind)
    worth = F.contains(text, F.lit(sign)) if sign else F.lit(True)
    worth = worth & text.rlike(PATTERNS[kind])
    return F.when(worth, F.filter(matches(text, PATTERNS[kind]), lambda m: is_valid(kind, m["found"]))).otherwise(F.array().cast(_SPANS))


def _instances(text: Column) -> Column:
    """Identifier-like runs, without the punctuation around them, with the text on either side.

    The text is cut into pieces first: what stands around a run is taken from two or three of them, not counted from the
    text's start for each run.
    """
    runs = F.when(text.rlike("[0-9@]"), matches(text, INSTANCE)).otherwise(F.array().cast(_SPANS))
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}+"), F.lit(0))

    def part(p: Column, at: Column, n: Column) -> Column:
        first = (at / PIECE).cast("int")
        return F.substring(F.array_join(F.slice(p, first + 1, F.lit(2)), ""), at - first * PIECE + 1, n)

    def trimmed(m: Column, p: Column) -> Column:
        core = F.regexp_replace(m["found"], r"""^["'\[{<,;:!?*#]+|["'\]}>.,;:!?*#]+$""", "")
        start = m["start"] + F.length(m["found"]) - F.length(F.regexp_replace(m["found"], r"""^["'\[{<,;:!?*#]+""", ""))
        before = F.greatest(start - CONTEXT, F.lit(0))
        return F.struct(
            start.alias("start"), (start + F.length(core)).alias("end"), core.alias("found"),
            part(p, before, start - before).alias("left"), part(p, start + F.length(core), F.lit(CONTEXT)).alias("right"))
    return _bound(pieces, lambda p: F.transform(runs, lambda m: trimmed(m, p)))


def _words(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    return F.filter(F.split(plain, r"\s+"), lambda w: w != "")


def _patterns(left: Column, right: Column) -> Column:
    """Lexical patterns of an instance: the two words before it, and the words on both sides."""
    before, after = _words(left), _words(right)
    last = F.element_at(before, -1)
    return F.filter(
        F.array(
            F.when(F.size(before) >= 2, F.concat(F.lit("L "), F.element_at(before, -2), F.lit(" "), last)),
            F.when((F.size(before) >= 1) & (F.size(after) >= 1), F.concat(F.lit("B "), last, F.lit(" "), F.element_at(after, 1))),
        ), lambda p: p.isNotNull())


def _seed_kind(found: Column) -> Column:
    kind = F.lit(None).cast("string")
    for k in reversed(KINDS):
        hit = F.regexp_extract(found, PATTERNS[k], 0)
        kind = F.when((hit != "") & is_valid(k, hit), F.lit(k)).otherwise(kind)
    return kind


def scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: doc_id, print (a hash of the text), base matches by kind, instances."""
    text = F.col("text")
    base = id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return base.select("doc_id", F.xxhash64("text").alias("print"), *(base_matches(k, text).alias(k) for k in KINDS), _instances(text).alias("instances"))


def score_graph(edges: DataFrame) -> DataFrame:
    """(instance, kind, score) of instances that are no seeds, from edges (pattern, instance, seed)."""
    kinds = F.explode(F.array(*map(F.lit, KINDS))).alias("kind")
    belief = stored(
        edges.select("instance", "seed").distinct().select("instance", "seed", kinds)
        .select("instance", "kind", F.when(F.col("seed") == F.col("kind"), 1.0).otherwise(0.0).alias("belief"), F.col("seed").isNotNull().alias("is_seed")),
        "pii-belief-0")
    graph = stored(edges.select("pattern", "instance").distinct(), "pii-graph")
    for turn in range(1, ROUNDS + 1):
        patterns = graph.join(belief, "instance").groupBy("pattern", "kind").agg(
            (F.sum("belief") / F.count(F.lit(1))).alias("confidence"), F.sum(F.when(F.col("is_seed"), F.col("belief")).otherwise(0.0)).alias("seeds"))
        patterns = stored(patterns.where((F.col("seeds") >= MIN_SEEDS) & (F.col("confidence") >= MIN_CONFIDENCE)), f"pii-patterns-{turn}")
        # an instance is not of a kind only if all its patterns are wrong
        reached = graph.join(patterns, "pattern").groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("score"))
        shape = F.lit(False)
        for k in KINDS:
            shape = F.when(F.col("kind") == k, F.col("instance").rlike(SHAPES[k])).otherwise(shape)
        score = F.when(shape, F.coalesce("score", F.lit(0.0))).otherwise(0.0)
        belief = stored(
            belief.join(reached, ["instance", "kind"], "left")
            .select("instance", "kind", F.when(F.col("is_seed"), F.col("belief")).otherwise(score).alias("belief"), "is_seed"), f"pii-belief-{turn}")
    return belief.where(~F.col("is_seed")).select("instance", "kind", F.col("belief").alias("score"))


def _digest_text(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(F.array_distinct(spans)), lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"], s["end"])), ",")


def _ranked(kind: str, spans: Column) -> Column:
    k = KINDS.index(kind) + 1
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))


def _clear_of(added: Column, base: Column) -> Column:
    """The added spans that overlap no base span; blocks of base spans in order are passed over by their bounds."""
    def blocks(spans: Column) -> Column:
        def block(j: Column) -> Column:
            own = F.slice(spans, j * BLOCK + 1, F.lit(BLOCK))
            return F.struct(F.array_min(own)["start"].alias("lo"), F.array_max(F.transform(own, lambda s: s["end"])).alias("hi"), own.alias("spans"))
        return F.transform(F.sequence(F.lit(0), ((F.size(spans) - 1) / BLOCK).cast("int")), block)

    def clear(held: Column) -> Column:
        return F.filter(added, lambda s: ~F.exists(held, lambda k: (k["lo"] < s["end"]) & (s["start"] < k["hi"]) & F.exists(
            k["spans"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))

    return F.when((F.size(added) == 0) | (F.size(base) == 0), added).otherwise(_bound(F.sort_array(base), lambda b: _bound(blocks(b), clear)))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and digest are of the base findings, ``spans`` holds those and the
    added ones. Null and empty texts have none. Rows repeated with the same id and
    text have the same findings; a null id is kept as such.
    """
    scanned = stored(scan(docs), "pii-scan")
    at = scanned.select("doc_id", "print", F.explode("instances").alias("i")).select("doc_id", "print", "i.*")
    at = stored(at.select(
        "doc_id", "print", "start", "end", F.col("found").alias("instance"), _seed_kind(F.col("found")).alias("seed"),
        _patterns(F.col("left"), F.col("right")).alias("patterns")), "pii-instances")
    scores = score_graph(at.select(F.explode("patterns").alias("pattern"), "instance", "seed"))
    best = scores.where(F.col("score") >= MIN_SCORE).groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    added = at.where("seed IS NULL").join(stored(best, "pii-added"), "instance").groupBy("doc_id", "print").agg(
        F.collect_set(F.struct("start", rank.alias("kind"), "end")).alias("added"))
    added = stored(added.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "added"), "pii-spans")
    rows = scanned.join(added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")), "left")
    base = F.concat(*(_ranked(k, F.col(k)) for k in KINDS))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    added = _clear_of(F.coalesce("added", none), base)
    return rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_digest_text(base).cast("binary"), 256).alias("base_sha256"), _digest_text(F.concat(base, added)).alias("spans"),
        F.size(added).cast("long").alias("n_added"))
