"""Secret scans through an index of trigrams.

Each rule is a pattern. What a match must contain is read off the pattern as a Boolean
query: one of several sets of trigrams, all of them present. An index lists, for every
trigram that some rule asks for, the documents that hold it; intersecting its lists gives
the candidates of a rule, and only they meet the pattern itself. A rule of which some
match needs no trigram has no query and scans every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import product
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexloom.llm.common import ascii_lower, content_key, stored
from vertexloom.llm.spans import let, named, spans_of

ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run of these characters ends where the characters end, so asking for its least length
# in the pattern finds the same as finding all runs and dropping the short ones. (It does
# not for assign: there a match that is too short may hide one that begins inside it.)
BASE_RULES = (
    Rule("assign", ASSIGN, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{15,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


def _runs(parsed: Iterable) -> list[tuple]:
    """Alternatives of a parsed pattern: literal characters in a row, None where anything may stand."""
    found: list[tuple] = [()]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            here = [(chr(value).lower(),)]
        elif name == "IN" and len(value) <= 8 and all(str(k) == "LITERAL" for k, _ in value):
            here = [(chr(c).lower(),) for _, c in value]
        elif name == "SUBPATTERN":
            here = _runs(value[-1])
        elif name == "BRANCH":
            here = [run for branch in value[1] for run in _runs(branch)]
        elif name == "MAX_REPEAT" and value[0] >= 1:
            here = [(*run, None) for run in _runs(value[2])]
        elif name == "MAX_REPEAT" and value[1] == 1 and all(str(k) == "LITERAL" for k, _ in value[2]):
            here = [(), *_runs(value[2])]
        else:
            here = [(None,)]
        if len(found) * len(here) > ALTERNATIVES:
            here = [(None,)]
        found = [a + b for a, b in product(found, here)]
    return found


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of lower-case trigrams: a text that matches holds all of at least one set. None: no such query."""
    sets = set()
    for run in _runs(regex_parser.parse(pattern)):
        pieces = "".join("\0" if c is None else c for c in run).split("\0")
        grams = frozenset(p[i : i + 3] for p in pieces for i in range(len(p) - 2))
        if not grams:
            return None
        sets.add(grams)
    return sorted(sets, key=sorted)


def trigram_index(docs: DataFrame, grams: Iterable[str]) -> DataFrame:
    """Postings ``gram``, ``_k1``, ``_k2`` of ``grams`` in ``docs`` (which has ``_k1``, ``_k2`` and ``text``).

    The table stays as the scans write it: a list of a trigram that most documents hold
    is never gathered in one place.
    """
    wanted = F.array(*[F.lit(g) for g in sorted(grams)])
    present = let(ascii_lower(F.col("text")), lambda lower: F.filter(wanted, lambda g: F.contains(lower, g)))
    return stored(docs.select("_k1", "_k2", F.explode(present).alias("gram")).distinct(), "trigram-index")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``_k1``, ``_k2`` and the ``kinds`` whose query the document meets."""
    spark = index.sparkSession
    rows = [
        (kind, number, gram, len(grams))
        for kind, sets in queries.items()
        for number, grams in enumerate(sets)
        for gram in grams
    ]
    terms = spark.createDataFrame(rows, "kind string, number int, gram string, wanted int")
    return (
        index.join(F.broadcast(terms), "gram")
        .groupBy("_k1", "_k2", "kind", "number")
        .agg(F.count(F.lit(1)).alias("met"), F.first("wanted").alias("wanted"))
        .where("met = wanted")
        .groupBy("_k1", "_k2")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _found(text: Column, rule: Rule) -> Column:
    return F.filter(spans_of(text, rule.pattern, rule.group), lambda s: F.char_length(s["value"]) >= rule.least)


def find_secrets(docs: DataFrame, rules: Iterable[Rule] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """``row`` (the document without its text) and ``found``: spans with start, end (code points) and kind.

    Spans of a kind are the leftmost non-overlapping matches of its pattern, less those
    whose group is too short. A null or empty text has none. Rows that agree in id and
    text share their index entries, and each gets the result. Extra columns travel inside
    ``row``. Rules are told apart by kind; there may be none, and then nothing is found.
    """
    rules = tuple(rules)
    for rule in rules:
        re.compile(rule.pattern)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: sets for kind, sets in queries.items() if sets}
    rest = F.struct(*[docs[c] for c in docs.columns if c.lower() != "text"])
    keyed = docs.select(
        rest.alias("row"), F.coalesce("text", F.lit("")).alias("text"), *content_key(F.col("doc_id"), F.col("text"))
    )
    scanned = [named(_found(F.col("text"), r), r.kind, i) for i, r in enumerate(rules) if r.kind not in indexed]
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    full = keyed.withColumn("scanned", F.concat(empty, *scanned))
    if not indexed:
        return full.select("row", F.array_sort("scanned").alias("found"))
    index = trigram_index(keyed, {g for sets in indexed.values() for grams in sets for g in grams})
    met = full.join(candidates(index, indexed), ["_k1", "_k2"], "left")
    verified = [
        F.when(F.array_contains("kinds", r.kind), named(_found(F.col("text"), r), r.kind, i)).otherwise(empty)
        for i, r in enumerate(rules)
        if r.kind in indexed
    ]
    return met.select("row", F.array_sort(F.concat("scanned", *verified)).alias("found"))
