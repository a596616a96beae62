"""Secrets in texts, found with a trigram inverted index.

A Boolean query of mandatory trigrams is derived from the regular expression of
each rule. The index holds, for each trigram, the texts that contain it. The
postings of a conjunction are intersected, and only the texts that remain are
searched with the expression. A rule without mandatory trigrams searches every
text. The index folds case, so it never misses a text that a rule matches.

Defined results
- null text is empty; it holds nothing. Spans count code points, end exclusive.
- per rule, matches are leftmost and do not overlap; a match whose group is too
  short is dropped, and the text it used is not searched again.
- equal rows get equal results; rows are told apart by a hash of id and text
  and joined back on it, so every input row comes out once.
- other columns are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from re import _parser  # the only parser of expressions in the standard library
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import key_text, materialise

Clauses = list[frozenset[str]]


class Rule(NamedTuple):
    """A match counts if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The kinds of secrets, in the order in which spans that start together are listed.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

MOST_STRINGS = 24


def trigram_query(pattern: str) -> Clauses:
    """Trigrams that a match must hold, lower case, as alternatives of conjunctions; empty if there are none.

    Walks the parsed expression and keeps the set of strings that the part read
    so far can end with exactly; where a part can vary too much, the trigrams of
    the strings before it are recorded and the set starts anew.
    """
    return _simplified(_walk(_parser.parse(pattern)))


def _grams(strings: set[str]) -> Clauses:
    return [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]


def _both(a: Clauses, b: Clauses) -> Clauses:
    out = {x | y for x, y in itertools.product(a, b)}
    return list(out) if len(out) <= MOST_STRINGS**2 else a


def _simplified(clauses: Clauses) -> Clauses:
    """No clause that another one implies; no query if some clause asks for nothing."""
    if any(not c for c in clauses):
        return []
    return sorted((c for c in set(clauses) if not any(d < c for d in clauses)), key=sorted)


def _exact(op: str, arg) -> set[str] | None:
    """All strings of one parsed item, lower case, or None if there are many."""
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        kinds = {str(o) for o, _ in arg}
        chars = {chr(a).lower() for o, a in arg if str(o) == "LITERAL"}
        return chars if kinds == {"LITERAL"} and len(chars) <= 8 else None
    if op in ("MAX_REPEAT", "MIN_REPEAT") and tuple(arg[:2]) == (0, 1):
        inner = _strings(arg[2])
        return None if inner is None else inner | {""}
    if op == "SUBPATTERN":
        return _strings(arg[-1])
    if op == "BRANCH":
        parts = [_strings(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    return None


def _strings(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        more = _exact(str(op), arg)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a, b in itertools.product(out, more)}
    return out


def _walk(items) -> Clauses:
    found, run = [frozenset()], {""}
    for op, arg in items:
        op, more = str(op), _exact(str(op), arg)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = {a + b for a, b in itertools.product(run, more)}
            continue
        found, run = _both(found, _grams(run)), more if more is not None else {""}
        if more is None and (op == "SUBPATTERN" or op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0):
            found = _both(found, _walk(arg[-1]))
        elif more is None and op == "BRANCH":
            found = _both(found, [c for x in arg[1] for c in _walk(x)])
    return _both(found, _grams(run))


def _row_key(id: str, text: Column) -> Column:
    return F.xxhash64(key_text(id), text)


def _one_of(grams: list[str]) -> str:
    """An expression that finds each trigram at each place, grouped by first character."""
    by_first = {k: [g[1:] for g in v] for k, v in itertools.groupby(sorted(grams), key=lambda g: g[0])}
    return "(?=(" + "|".join(f"{re.escape(k)}(?:{'|'.join(map(re.escape, v))})" for k, v in by_first.items()) + "))"


def trigram_index(docs: DataFrame, *, id: str = "doc_id", text: str = "text", vocabulary: list[str] | None = None) -> DataFrame:
    """Postings (``trigram``, ``key``): one row for each text and trigram that it holds.

    With a vocabulary, only its trigrams get postings: those of the rules that will be asked.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # A place in the middle of a character beyond 16 bits is no start.
    pattern = r"(?s)(?=([^\x{D800}-\x{DFFF}]..))" if vocabulary is None else _one_of(vocabulary) if vocabulary else "(?!)()"
    grams = F.array_distinct(F.regexp_extract_all(F.lower(body), F.lit(pattern), F.lit(1)))
    return docs.select(_row_key(id, body).alias("key"), F.explode(grams).alias("trigram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(``key``, ``kinds``): the texts that hold every trigram of some conjunction of a rule.

    Each posting meets the conjunctions that ask for its trigram; a text that
    gathers all trigrams of one is in the intersection of their postings.
    """
    asked = [(r.kind, f"{r.kind}{n}", len(c), g) for r in rules for n, c in enumerate(trigram_query(r.pattern)) for g in sorted(c)]
    spark = postings.sparkSession
    clauses = spark.createDataFrame(asked, "kind string, clause string, n int, trigram string")
    met = postings.join(F.broadcast(clauses), "trigram").groupBy("key", "kind", "clause", "n").agg(F.count_distinct("trigram").alias("have"))
    return met.where("have = n").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end, kind>> of the matches of one rule.

    The pieces between the matches and the matches themselves alternate, so
    running lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    parts = F.zip_with(F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("n"))), kept, lambda p, k: F.struct(p["gap"].alias("gap"), p["n"].alias("n"), F.length(k).alias("k")))
    none = F.array().cast("array<struct<start:int,end:int,k:int>>")
    placed = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda s, p: F.struct(
            (s["at"] + p["gap"] + p["n"]).alias("at"),
            F.when(p["k"] >= rule.least, F.concat(s["out"], F.array(F.struct((s["at"] + p["gap"]).alias("start"), (s["at"] + p["gap"] + p["n"]).alias("end"), p["k"].alias("k"))))).otherwise(s["out"]).alias("out"),
        ),
    )["out"]
    return F.transform(placed, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def _whole_runs(rule: Rule) -> Rule:
    """A rule that scans every text finds long runs of one class directly: a run that is too short holds no match at all."""
    run = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return rule._replace(pattern=f"{run[1]}{{{rule.least},}}", least=1) if run else rule


def scan(docs: DataFrame, *, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: the id and ``found``, array<struct<start, end, rank, kind>> in order of start, then of the rules."""
    body = F.coalesce(F.col(text), F.lit(""))
    indexed = [r for r in rules if trigram_query(r.pattern)]
    unindexed = [_whole_runs(r) for r in rules if not trigram_query(r.pattern)]
    rank = {r.kind: n for n, r in enumerate(rules)}

    def tagged(value: Column, rule: Rule) -> Column:
        return F.transform(spans(value, rule), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(rank[rule.kind]).alias("rank"), F.lit(rule.kind).alias("kind")))

    none = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string>>")
    everywhere = F.concat(none, *[tagged(F.col("_body"), r) for r in unindexed])
    rows = docs.select(F.col(id), _row_key(id, body).alias("key"), body.alias("_body")).select(id, "key", everywhere.alias("_all"))
    if not indexed:
        return rows.select(id, F.array_sort("_all").alias("found"))
    vocabulary = sorted({g for r in indexed for c in trigram_query(r.pattern) for g in c})
    postings = materialise(trigram_index(docs, id=id, text=text, vocabulary=vocabulary), name="trigrams")
    asked = materialise(candidates(postings, tuple(indexed)), name="secret-candidates")
    verified = docs.select(_row_key(id, body).alias("key"), body.alias("_body")).join(asked, "key")
    hits = F.concat(none, *[F.when(F.array_contains("kinds", r.kind), tagged(F.col("_body"), r)).otherwise(none) for r in indexed])
    verified = verified.select("key", hits.alias("_hits")).where(F.size("_hits") > 0).groupBy("key").agg(F.first("_hits").alias("_hits"))
    joined = rows.join(verified, "key", "left")
    return joined.select(id, F.array_sort(F.concat("_all", F.coalesce("_hits", none))).alias("found"))


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
