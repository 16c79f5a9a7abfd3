"""Personal data: fixed patterns, and more of it found by contextual extraction from these seeds.

What the fixed patterns find are seeds. The word before a seed is a lexical pattern; the
identifiers that stand behind such words are instances. Patterns and instances score each
other in rounds: a pattern is worth the share of all places of its word, in the whole
corpus, that hold trusted instances, and an instance is worth its best pattern. Rounds go
on until no score changes. Patterns above a high confidence in the end mark identifiers
that no fixed pattern knows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexloom.llm.common import ascii_lower, content_key, stored
from vertexloom.llm.spans import SPAN, let, named, spans_of

CONFIDENCE = 0.5
SUPPORT = 5
#: Scores are whole numbers of so many parts: they only go up, so the rounds come to an end.
SCORE_PARTS = 10**6
BROADCAST_PATTERNS, BROADCAST_BYTES = 200_000, 32 * 1024 * 1024
KINDS = ("email", "ip", "card", "phone")
FOUND_KIND = "context"

# The base patterns, written so that no place of a text is tried over and over: runs are
# taken whole, and a match begins where its run begins or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
DIGITS_OF_IDENTIFIER = 4
# Looking ahead for the digits first leaves out the words of a text, none of which could be one.
IDENTIFIER = (
    r"(?<![A-Za-z0-9#+._@/-])(?=(?:[A-Za-z#+._@/-]*+[0-9]){%d})" % DIGITS_OF_IDENTIFIER
    + r"[A-Za-z0-9#+][A-Za-z0-9#+._@/-]*[A-Za-z0-9](?![A-Za-z0-9#+_@/-])"
)
NEAR, BLANK, OPENING = 64, r"[\x20\x09-\x0D]", r"[(\[\"']"
ENOUGH_DIGITS = r"(?:[0-9][^0-9]*+){%d}" % DIGITS_OF_IDENTIFIER


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def small_parts(value: Column) -> Column:
    """All four numbers at most 255."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.coalesce(F.try_to_number(p, F.lit("999")), F.lit(0)) <= 255))


def luhn(value: Column) -> Column:
    def check(number: Column) -> Column:
        def part(i: Column) -> Column:
            digit = F.substring(number, -(i + 1), F.lit(1)).cast("int")
            twice = digit * 2
            return F.when(i % 2 == 0, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

        places = F.sequence(F.lit(0), F.char_length(number) - 1)
        return F.aggregate(places, F.lit(0), lambda total, i: total + part(i)) % 10 == 0

    return let(digits(value), check)


def base_spans(text: Column) -> list[Column]:
    """Spans of each of ``KINDS``."""
    count = lambda s: F.char_length(digits(s["value"]))
    return [
        F.when(F.contains(text, F.lit("@")), spans_of(text, EMAIL)).otherwise(F.array().cast(f"array<{SPAN}>")),
        F.filter(spans_of(text, IP), lambda s: small_parts(s["value"])),
        F.filter(spans_of(text, CARD), lambda s: luhn(s["value"])),
        F.filter(spans_of(text, PHONE), lambda s: (count(s) >= 10) & (count(s) <= 15)),
    ]


def word_before(text: Column, start: Column) -> Column:
    """The lower-case word that ends before a place of the text, on the same line; empty if there is none.

    Blanks and one opening mark may stand between. Word and blanks may be of any length:
    where they fill the ``NEAR`` code points before the place, all of the text before it is
    looked at.
    """
    near = F.substring(text, F.greatest(F.lit(1), start - (NEAR - 1)), F.least(start, F.lit(NEAR)))
    word = F.regexp_extract(near, rf"(?:^|{BLANK})([^{BLANK[1:]}+)\x20+{OPENING}?\z", 1)
    cut = (start > NEAR) & near.rlike(rf"^[^{BLANK[1:]}*\x20*{OPENING}?\z")
    back = F.reverse(F.substring(text, F.lit(1), start))
    far = F.reverse(F.regexp_extract(back, rf"^{OPENING}?\x20+([^{BLANK[1:]}+)", 1))
    return ascii_lower(F.when(cut, far).otherwise(word))


@dataclass(frozen=True)
class Bootstrap:
    """How far patterns are trusted; without ``rounds``, scores go on until none changes."""

    rounds: int | None = None
    confidence: float = CONFIDENCE
    support: int = SUPPORT


def _occurrences(keyed: DataFrame) -> DataFrame:
    """``_k1``, ``_k2``, ``start``, ``end``, ``value``, ``pattern`` and ``seed``: seeds, and identifiers
    apart from them, with the word before."""

    def overlaps(s: Column) -> Column:
        return F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    enough = F.filter(spans_of(F.col("text"), IDENTIFIER), lambda s: F.char_length(digits(s["value"])) >= DIGITS_OF_IDENTIFIER)
    text = F.col("text")

    def occurrence(start: Column, end: Column, value: Column, seed: bool) -> Column:
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            value.alias("value"),
            word_before(text, start).alias("pattern"),
            F.lit(seed).alias("seed"),
        )

    seeds = F.transform(
        "base", lambda b: occurrence(b["start"], b["end"], F.substring(text, b["start"] + 1, b["end"] - b["start"]), True)
    )
    others = F.filter(enough, lambda s: ~overlaps(s))
    marked = F.concat(seeds, F.transform(others, lambda s: occurrence(s["start"], s["end"], s["value"], False)))
    able = keyed.where(text.rlike(ENOUGH_DIGITS) | (F.size("base") > 0))
    found = able.select("_k1", "_k2", F.explode(marked).alias("o")).select("_k1", "_k2", "o.*")
    return found.where("pattern <> ''").distinct()


def _pattern_places(keyed: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern`` and ``places``: how often each word of ``patterns`` stands in all texts; rows of one key count once."""
    keys = ["_k1", "_k2"]
    copies = stored(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "copies")
    few = copies.count() <= BROADCAST_PATTERNS
    size = patterns.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0)).alias("b")).first()
    small = size["n"] <= BROADCAST_PATTERNS and size["b"] <= BROADCAST_BYTES
    if few:
        copies = F.broadcast(copies)
        # rows without copies need no key, and add up before they move
        marked = keyed.join(copies, keys, "left")
        keyed = marked.select(*[F.when(F.col("copies").isNotNull(), F.col(k)).alias(k) for k in keys], "text")
    words = keyed.select(*keys, F.explode(F.split(ascii_lower(F.col("text")), "[\\x20\\x09-\\x0D]+")).alias("pattern"))
    met = words.join(F.broadcast(patterns) if small else patterns, "pattern")
    times = met.groupBy(*keys, "pattern").agg(F.count(F.lit(1)).alias("times"))
    once = F.expr("times div coalesce(copies, 1)")
    return times.join(copies, keys, "left").groupBy("pattern").agg(F.sum(once).alias("places"))


def trusted_patterns(occurrences: DataFrame, keyed: DataFrame, how: Bootstrap) -> DataFrame:
    """``pattern`` and ``score`` of the confident patterns after the last round."""
    edges = stored(
        occurrences.groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("times"), F.max("seed").alias("seed")),
        "pattern-edges",
    )
    # A pattern needs this many different trusted instances, so words before fewer
    # identifiers than that drop out before the corpus is counted.
    able = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") >= how.support)
    places = stored(_pattern_places(keyed, able.select("pattern")), "pattern-places")
    edges = stored(edges.join(places, "pattern"), "pattern-graph")
    scores, before, done = edges.select("pattern").limit(0).withColumn("score", F.lit(0).cast("long")), (0, 0), 0
    while how.rounds is None or done < how.rounds:
        known = F.when(F.col("seed"), F.lit(SCORE_PARTS)).otherwise(F.coalesce("score", F.lit(0)))
        trust = edges.join(scores, "pattern", "left").groupBy("value").agg(F.max(known).alias("trust"))
        worth = F.expr("(2 * sum(times * trust) + max(places)) div (2 * max(places))")
        scores = stored(
            edges.join(trust, "value")
            .groupBy("pattern")
            .agg(worth.alias("score"), F.count_if(F.col("trust") > 0).alias("support"))
            .where((F.col("support") >= how.support) & (F.col("score") >= round(how.confidence * SCORE_PARTS)))
            .select("pattern", "score"),
            "pattern-scores",
        )
        # Trust only goes up from round to round, so equal sums are equal scores.
        after = tuple(scores.agg(F.count(F.lit(1)), F.coalesce(F.sum("score"), F.lit(0))).first())
        if after == before:
            break
        before, done = after, done + 1
    return scores


def find_private_data(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:  # noqa: B008
    """``row`` (the document without its text) and ``found``: spans with start, end (code points) and kind.

    ``KINDS`` are matches of the fixed patterns, leftmost and non-overlapping by kind;
    ``context`` are identifiers behind a trusted word that overlap none of them. A null or
    empty text has none. Rows that agree in id and text count once as evidence, and each
    gets the result. Extra columns travel inside ``row``. Without seeds nothing is learned.
    """
    rest = F.struct(*[docs[c] for c in docs.columns if c.lower() != "text"])
    key = content_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select(rest.alias("row"), F.coalesce("text", F.lit("")).alias("text"), *key)
    base = F.flatten(F.array(*[named(s, k, i) for i, (k, s) in enumerate(zip(KINDS, base_spans(F.col("text")), strict=True))]))
    scanned = keyed.withColumn("base", base)
    occurrences = stored(_occurrences(scanned), "identifiers")
    confident = trusted_patterns(occurrences, keyed.select("_k1", "_k2", "text"), how)
    added = F.struct(
        F.col("start"), F.lit(len(KINDS)).alias("rank"), F.col("end"), F.lit(FOUND_KIND).alias("kind")
    )
    discovered = (
        occurrences.where(~F.col("seed"))
        .join(confident, "pattern")
        .groupBy("_k1", "_k2")
        .agg(F.collect_set(added).alias("more"))
    )
    more = F.coalesce("more", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))
    return scanned.drop("text").join(discovered, ["_k1", "_k2"], "left").select(
        "row", F.array_sort(F.concat("base", more)).alias("found")
    )
