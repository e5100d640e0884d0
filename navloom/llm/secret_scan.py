"""Secrets by regular expressions behind a trigram index, in DataFrame functions alone."""

from __future__ import annotations

import re._constants as codes
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import quoted, text_of, whole_row
from navloom.llm.spans import labelled, listed, spans_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the part and length that a match needs."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of letters that is too short has no longer one inside, so the shortest length can stand in the pattern; a value of
#: ``assign`` that is too short hides what follows in it, so its length is asked after the match.
BASE = (Rule("assign", ASSIGN, 2, 12), Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18), Rule("hex", "[0-9a-f]{16,}", 0, 16))
#: Formats of tokens that several vendors document.
MORE = (
    Rule("github", "gh[opsru]_[A-Za-z0-9]{36,255}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,255}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "sk_live_[A-Za-z0-9]{16,255}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("url", r"://[^/\s:@]{1,255}:[^/\s:@]{1,255}@"),
)

#: A query in conjunctive form: of each clause one alternative, of each alternative all trigrams.
Query = tuple[frozenset[frozenset[str]], ...]
#: Most strings that are followed side by side.
MANY = 64


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[k : k + 3] for k in range(len(text) - 2))


def _clause(strings: set[str]) -> list[frozenset[frozenset[str]]]:
    """One of the strings must occur; without a trigram in each of them this asks for nothing."""
    sets = {_trigrams(s) for s in strings}
    if not strings or frozenset() in sets:
        return []
    return [frozenset(a for a in sets if not any(b < a for b in sets))]


def _read(nodes) -> tuple[set[str] | None, list[frozenset[frozenset[str]]]]:
    """Of a sequence: all strings that it matches if they are few, else None; and the clauses that it asks for."""
    strings: set[str] = {""}
    clauses: list[frozenset[frozenset[str]]] = []
    exact = True
    for op, arg in nodes:
        some, below = _one(op, arg)
        if some is not None and len(strings) * len(some) <= MANY:
            strings = {a + b for a in strings for b in some}
            continue
        clauses += _clause(strings) + (below if some is None else _clause(some))
        strings, exact = {""}, False
    return (strings if exact else None), clauses + ([] if exact else _clause(strings))


def _one(op, arg) -> tuple[set[str] | None, list[frozenset[frozenset[str]]]]:
    if op is codes.LITERAL:
        return {chr(arg).lower()}, []
    if op is codes.IN:
        letters = {chr(v).lower() for o, v in arg if o is codes.LITERAL}
        return (letters, []) if len(letters) == len(arg) and len(letters) <= 8 else (None, [])
    if op is codes.SUBPATTERN:
        return _read(arg[3])
    if op is codes.BRANCH:
        parts = [_read(p) for p in arg[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*(s for s, _ in parts)), []
        firsts = [(_clause(s) if s is not None else c)[:1] for s, c in parts]
        return None, [frozenset().union(*(f[0] for f in firsts))] if all(firsts) else []
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT):
        least, most, inner = arg
        strings, clauses = _read(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, []
        if least == 0:
            return None, []
        return None, _clause(strings) if strings is not None else clauses
    if op is codes.ATOMIC_GROUP:
        return _read(arg)
    if op in (codes.AT, codes.ASSERT, codes.ASSERT_NOT):
        return {""}, []
    return None, []


def trigram_query(pattern: str) -> Query:
    """What a text must contain, in lower case, to match; empty if the pattern asks for no trigram."""
    strings, clauses = _read(parser.parse(pattern))
    return tuple(clauses + (_clause(strings) if strings is not None else []))


def postings(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Inverted index of the trigrams that the rules ask for: ``trigram``, ``key`` of the rows whose text has it."""
    asked = sorted({t for r in rules for clause in trigram_query(r.pattern) for alternative in clause for t in alternative})
    terms = F.array(*[F.lit(t) for t in asked])
    there = F.flatten(F.transform(F.array(F.lower("text")), lambda text: F.filter(terms, lambda t: F.contains(text, t))))
    return rows.select("key", F.explode(there).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``key`` and the ``rules`` whose query the row's postings meet; rows that meet none are not in it."""
    has = lambda trigrams: F.size(F.array_intersect("found", F.array(*[F.lit(t) for t in sorted(trigrams)]))) == len(trigrams)

    def meets(query: Query) -> Column:
        whole = F.lit(True)
        for clause in query:
            one = F.lit(False)
            for alternative in sorted(clause, key=sorted):
                one = one | has(alternative)
            whole = whole & one
        return whole

    asking = [(r.kind, trigram_query(r.pattern)) for r in rules]
    found = index.groupBy("key").agg(F.collect_set("trigram").alias("found"))
    named = F.array_compact(F.array(*[F.when(meets(q), F.lit(k)) for k, q in asking if q]))
    return found.select("key", named.alias("rules")).where(F.size("rules") > 0)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[Rule, ...] = MORE) -> DataFrame:
    """One row per input row: ``row``, an array of (start, place, end, kind) for each base rule (``assign``, ``access``,
    ``hex``), and ``more`` with the spans of the other rules.  Positions are code points, ends are exclusive.

    The queries derived from the patterns are answered by the postings of their trigrams; only rows that meet a rule's
    query are searched by its pattern.  A rule without a mandatory trigram (``hex``) searches every row.  The key is a hash
    of text and id; rows that share one share their candidates, and a search decides each of them.

    Null or empty text: no spans.  Null id: hashed as no id.  Repeated rows get the same spans.  Empty table: no rows.
    """
    rules = BASE + tuple(more)
    rows = docs.select(whole_row(docs), text_of(text_col).alias("text"), F.col(quoted(id_col)).cast("string").alias("id"))
    rows = rows.select("row", "text", F.xxhash64("text", "id").alias("key"))
    rows = rows.join(candidates(postings(rows, rules), rules), "key", "left")

    def spans(rule: Rule) -> Column:
        wanted = F.array_contains("rules", rule.kind) if trigram_query(rule.pattern) else F.lit(True)
        every = spans_of(F.col("text"), rule.pattern, wanted)
        if not rule.least:
            return every
        part = (lambda s: F.regexp_extract(s["hit"], rule.pattern, rule.group)) if rule.group else (lambda s: s["hit"])
        return F.filter(every, lambda s: F.length(part(s)) >= rule.least)

    base = [labelled(spans(r), r.kind, place).alias(r.kind) for place, r in enumerate(BASE)]
    extra = F.concat(F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>"), *[labelled(spans(r), r.kind, len(BASE) + k) for k, r in enumerate(more)])
    return rows.select("row", *base, extra.alias("more"))


def summary() -> list[Column]:
    """Counts of the base kinds, the hash of their list, and the list of all spans."""
    base = F.concat(*[F.col(r.kind) for r in BASE])
    counts = [F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return [*counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.concat(base, F.col("more"))).alias("spans")]
