"""Text functions. Built-ins wherever Spark has them; an Arrow UDF for NFKC."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom import constants as C

#: Python's idea of white space, for Java patterns; the (?U) class lacks the four separators.
_SPACE = r"(?U)[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Without white space of any Unicode kind at both ends; null stays null."""
    return F.regexp_replace(c, rf"{_SPACE}+$|^{_SPACE[4:]}+", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{_SPACE}+", " "))


def nfkc(c: Column) -> Column:
    """NFKC; only texts beyond ASCII are sent to Python's normaliser, which Spark lacks."""

    @F.pandas_udf("string")
    def normal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")

    return normal(c)


def normalize(c: Column) -> Column:
    """NFKC, lower case, white space collapsed and stripped; null gives ''."""
    return collapse(F.lower(nfkc(F.coalesce(c, F.lit("")))))


def normalize_term(term: str) -> str:
    """``normalize`` of a parameter, on the driver."""
    return " ".join(unicodedata.normalize("NFKC", term).replace("　", " ").lower().split())


def alias_pattern(alias: str) -> str | None:
    """A Java pattern that finds an alias with white space anywhere inside; None for a blank alias."""
    compact = re.sub(r"\s+", "", normalize_term(alias))
    return "(?U)" + r"\s*".join("\\x{%x}" % ord(c) for c in compact) if compact else None


def mention_count(normalized: Column, aliases: Sequence[str]) -> Column:
    """Sum over aliases of their occurrences in normalised text; overlapping aliases count each."""
    patterns = [p for a in aliases if (p := alias_pattern(a))]
    total = F.lit(0)
    for p in patterns:
        total = total + F.regexp_count(normalized, F.lit(p))
    return total.cast("bigint")


def is_refusal(c: Column, sentences: Sequence[str] = C.REFUSAL_SENTENCES) -> Column:
    """Whether the text is a refusal sentence and nothing else; null is none."""
    return F.coalesce(strip(c).isin(*sentences), F.lit(False))


def is_busy(c: Column, markers: Sequence[str] = C.BUSY_MARKERS, most: int = C.BUSY_MOST_CHARS) -> Column:
    """Whether a short text holds all markers of a busy service."""
    text = collapse(c)
    found = F.length(text) <= most
    for m in markers:
        found = found & F.contains(text, F.lit(m))
    return F.coalesce(found, F.lit(False))


def quota_pattern(phrases: Sequence[str] = C.QUOTA_PHRASES) -> str:
    """A pattern of a whole notice: one of the phrases between courtesies. Any engine takes it."""
    before, marks, after, end = C.QUOTA_COURTESIES
    return "".join(["^(?:", before, ")?(?:", "|".join(map(re.escape, phrases)), ")(?:", marks, "(?:", after, ")?", end, ")?$"])


def is_quota_exhausted(c: Column, phrases: Sequence[str] = C.QUOTA_PHRASES, most: int = C.QUOTA_MOST_CHARS) -> Column:
    """Whether a text is a notice of an exhausted quota, with or without courtesies around it."""
    text = collapse(c)
    return F.coalesce(F.length(text).between(1, most) & text.rlike(quota_pattern(phrases)), F.lit(False))


def shows_risk_control(c: Column, texts: Sequence[str] = C.RISK_TEXTS) -> Column:
    """Whether a page shows any of the texts of a risk control."""
    found = F.lit(False)
    for t in texts:
        found = found | F.coalesce(F.contains(c, F.lit(t)), F.lit(False))
    return found


def is_valid_answer(status: Column, answer: Column) -> Column:
    """Passed, with a text that is not blank and no refusal."""
    return F.coalesce((status == "pass") & (F.length(strip(answer)) > 0) & ~is_refusal(answer), F.lit(False))


def rule_hits(normalized: Column, rules: Sequence[tuple[str, Sequence[str]]], markers: Sequence[str]) -> Column:
    """array<struct<rule, term, start, evidence>>: rule terms in normalised text that no negation precedes.

    In the order of rules, terms and places; start counts from 1. All of it is built-in expressions
    over arrays, so it stays in the JVM.
    """

    def free(i: Column) -> Column:
        start = F.greatest(F.lit(1), i - C.NEGATION_REACH)
        before = F.substr(normalized, start, i - start)
        negated = F.lit(False)
        for m in markers:
            negated = negated | F.contains(before, F.lit(m))
        return ~negated

    def described(rule: str, term: str):
        def hit(i: Column) -> Column:
            start = F.greatest(F.lit(1), i - C.EVIDENCE_REACH)
            end = F.least(F.length(normalized), i + len(term) - 1 + C.EVIDENCE_REACH)
            return F.struct(F.lit(rule).alias("rule"), F.lit(term).alias("term"), i.alias("start"),
                F.trim(F.substr(normalized, start, end - start + 1)).alias("evidence"))

        return hit

    def starts(term: str):
        return lambda i: F.substr(normalized, i, F.lit(len(term))) == term

    parts, none = [], F.array().cast("array<int>")
    for rule, terms in rules:
        for term in map(normalize_term, terms):
            # sequence() counts down where the text is shorter than the term, so that is asked first.
            places = F.when(F.contains(normalized, F.lit(term)), F.sequence(F.lit(1), F.length(normalized) - len(term) + 1)).otherwise(none)
            parts.append(F.transform(F.filter(F.filter(places, starts(term)), free), described(rule, term)))
    return F.concat(*parts)


#: What ends a line, as Python's ``splitlines`` has it.
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: A tail of cards in the letters of ``_line_kinds``, read from the last line up.
_CARDS = "^(?:N[NT]D?)+"


def _line_kinds() -> tuple[tuple[str, str], ...]:
    """Letters of stripped lines and their patterns, the first that fits counts: D duration, N name (fit for a title too), T title."""
    return tuple((k, f"^{p}$") for k, p in (("D", C.CARD_DURATION), ("N", C.CARD_CREATOR), ("T", C.CARD_TITLE)))


def strip_cards(text: str | None, mode: str | None) -> str:
    """``clean_answer`` of one text, on the driver."""
    value = (text or "").strip()
    lines = re.split(_LINE_END, value)
    kind = lambda line: next((k for k, p in _line_kinds() if re.search(p, line.strip())), "-")
    tail = re.match(_CARDS, "".join(map(kind, reversed(lines)))) if mode == "quick" else None
    return "\n".join(x.rstrip() for x in lines[: len(lines) - tail.end()]).rstrip() if tail else value


def clean_answer(answer: Column, mode: Column) -> Column:
    """A quick answer without the recommendation cards at its end, stripped; null gives ''.

    A card is (duration,) title and creator, a line each. Every line becomes a letter for what it can be,
    and the letters, last line first, are matched as a whole: all of it built-ins, without a loop.
    """
    value = strip(F.coalesce(answer, F.lit("")))

    def kind(line: Column) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for letter, pattern in _line_kinds():
            out = out.when(strip(line).rlike(f"(?U){pattern}"), letter)
        return out.otherwise("-")

    lines = F.split(value, _LINE_END)
    shape = F.reverse(F.array_join(F.transform(lines, kind), ""))
    # The possessive form runs without recursion; the letters leave one reading only.
    cards = F.length(F.regexp_extract(shape, f"{_CARDS}+", 0))
    ends = rf"{_SPACE}+$"
    kept = F.regexp_replace(F.array_join(F.transform(F.slice(lines, F.lit(1), F.size(lines) - cards),
        lambda x: F.regexp_replace(x, ends, "")), "\n"), ends, "")
    return F.when((mode == "quick") & (cards > 0), kept).otherwise(value)


def unquoted(c: Column) -> Column:
    """Without quotation marks at both ends, then trimmed."""
    return strip(F.regexp_replace(c, "^[\"“”']+|[\"“”']+$", ""))


def distinct_queries(queries: Column) -> Column:
    """Search queries unquoted, blanks dropped, each once in the order first seen."""
    return F.array_distinct(F.filter(F.transform(queries, unquoted), lambda q: F.length(q) > 0))


def anchor_request(anchor: Column) -> Column:
    """The request that a reference link's anchor id names; null for other ids and for none."""
    name = strip(anchor)
    rest = strip(F.substr(name, F.lit(len(C.ANCHOR_PREFIX) + 1)))
    return F.when(F.startswith(name, F.lit(C.ANCHOR_PREFIX)) & (rest != ""), rest)


def search_heading(heading: Column) -> Column:
    """struct<keywords, articles> that a heading of a search announces; null for other texts."""
    value = strip(heading)
    count = lambda n: F.regexp_extract(value, C.SEARCH_HEADING, n).try_cast("int")
    return F.when(value.rlike(C.SEARCH_HEADING), F.struct(count(1).alias("keywords"), count(2).alias("articles")))


def is_source_heading(c: Column) -> Column:
    """Whether a text is the number of an answer's sources and nothing else; null is none."""
    return F.coalesce(c.rlike(f"(?U){C.SOURCE_HEADING}"), F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 where whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
