"""Personal data in text: scan, numbered placeholders, and putting the values back."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let

# Fixed patterns: e-mail address and ddd-ddd-dddd phone number (any Unicode digit), unanchored.
EMAIL_PATTERN = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
PHONE_PATTERN = r"\p{Nd}{3}-\p{Nd}{3}-\p{Nd}{4}"
CARD_PATTERN = r"(?a)\b[0-9]{4}(?:[ -]?[0-9]{4}){3}\b"
PATTERNS = {"EMAIL": EMAIL_PATTERN, "PHONE": PHONE_PATTERN, "CARD": CARD_PATTERN}
EITHER_PATTERN = f"{EMAIL_PATTERN}|{PHONE_PATTERN}"
PLACEHOLDER_PATTERN = r"\[(?:EMAIL|PHONE)_([0-9]{1,9})\]"

KIND_PLACEHOLDER = r"\[[A-Z][A-Z_]*_([0-9]{1,9})\]"

PRIVACY_PASSED = "PASSED"
PRIVACY_FLAGGED = "FLAGGED (Contains PII)"


def has_pii(text: Column | str) -> Column:
    c = F.coalesce(col(text), F.lit(""))
    email = F.contains(c, F.lit("@")) & F.rlike(c, F.lit(EMAIL_PATTERN))
    return email | F.rlike(c, F.lit(PHONE_PATTERN))


def privacy_label(pii_found: Column | str) -> Column:
    return F.when(col(pii_found), PRIVACY_FLAGGED).otherwise(PRIVACY_PASSED)


def redaction(text: Column | str) -> Column:
    """Struct ``redacted`` and ``placeholders`` (array of placeholder and value).

    Equal values share one placeholder, numbered by first appearance. Numbers start
    above any placeholder the text already holds, so putting values back is exact. Texts
    the scan finds nothing in are passed on without further matching.
    """
    c = col(text)
    hits = F.regexp_extract_all(c, F.lit(EITHER_PATTERN), F.lit(0))
    taken = F.transform(
        F.regexp_extract_all(c, F.lit(PLACEHOLDER_PATTERN), F.lit(1)), lambda n: n.cast("bigint")
    )
    parts = F.split(c, EITHER_PATTERN, -1)

    def name(value: Column, number: Column) -> Column:
        kind = F.when(F.contains(value, F.lit("@")), "EMAIL").otherwise("PHONE")
        return F.concat(F.lit("["), kind, F.lit("_"), number.cast("string"), F.lit("]"))

    def build(s: Column) -> Column:
        base = F.coalesce(F.array_max(s["taken"]), F.lit(0).cast("bigint"))
        named = F.transform(s["hits"], lambda v: name(v, base + F.array_position(s["values"], v)))
        text_out = F.array_join(
            F.zip_with(s["parts"], named, lambda p, h: F.concat(p, F.coalesce(h, F.lit("")))), ""
        )
        pairs = F.transform(
            s["values"],
            lambda v, i: F.struct(name(v, base + i + 1).alias("placeholder"), v.alias("value")),
        )
        return F.struct(text_out.alias("redacted"), pairs.alias("placeholders"))

    replaced = let(
        F.struct(
            hits.alias("hits"), F.array_distinct(hits).alias("values"),
            taken.alias("taken"), parts.alias("parts"),
        ),
        build,
    )
    none = F.array().cast("array<struct<placeholder:string,value:string>>")
    same = F.struct(c.alias("redacted"), none.alias("placeholders"))
    return F.when(has_pii(c), replaced).otherwise(same)


Span = tuple[str, int, int]


def chosen_spans(spans: list[Span]) -> list[Span]:
    """Non-overlapping spans (kind, start, end): leftmost first, of those with one start the longest,
    of equal ones the first given."""
    out, free = [], 0
    for span in sorted(spans, key=lambda s: (s[1], -s[2])):
        if span[1] >= free:
            out.append(span)
            free = span[2]
    return out


def redaction_of_kinds(
    text: Column | str, patterns: dict[str, str], recogniser: Callable[[list[str]], list[list[Span]]] | None = None
) -> Column:
    """``redaction`` for any kinds of value: patterns by kind, and spans of a user's recogniser.

    Patterns are in the syntax of the ``regex`` module. The recogniser gets a batch of texts and
    gives (kind, start, end) in characters for each. Spans that overlap are settled leftmost
    first, then longest, then in the order of the patterns with the recogniser last. Equal values
    share one placeholder, of the kind they first appear as; numbers start above any placeholder
    in the text. A null text stays null. Texts travel in Arrow batches; a batch is read once.
    """
    for kind in patterns:
        if not kind.isascii() or not kind.replace("_", "").isupper():
            raise ValueError("kinds are made of A-Z and _")

    def redact(texts: pd.Series) -> pd.DataFrame:
        import regex

        searches = [(kind, regex.compile(p)) for kind, p in patterns.items()]
        taken = regex.compile(KIND_PLACEHOLDER)
        known = [t for t in texts if t is not None]
        recognised = iter(recogniser(known) if recogniser and known else [[] for _ in known])
        redacted, placeholders = [], []
        for text in texts:
            if text is None:
                redacted.append(None)
                placeholders.append([])
                continue
            spans = [(kind, m.start(), m.end()) for kind, p in searches for m in p.finditer(text) if m.end() > m.start()]
            for kind, start, end in next(recognised):
                if not 0 <= start < end <= len(text):
                    raise ValueError("a span of the recogniser lies outside the text")
                spans.append((kind, start, end))
            number = max((int(m) for m in taken.findall(text)), default=0) if spans else 0
            names, pieces, at = {}, [], 0
            for kind, start, end in chosen_spans(spans):
                value = text[start:end]
                if value not in names:
                    names[value] = f"[{kind}_{number + len(names) + 1}]"
                pieces += [text[at:start], names[value]]
                at = end
            redacted.append("".join([*pieces, text[at:]]))
            placeholders.append([{"placeholder": n, "value": v} for v, n in names.items()])
        return pd.DataFrame({"redacted": redacted, "placeholders": placeholders})

    kind = "struct<redacted:string,placeholders:array<struct<placeholder:string,value:string>>>"
    return F.pandas_udf(redact, kind)(col(text))


def restored(text: Column | str, placeholders: Column | str) -> Column:
    """Values put back for the placeholders; unknown placeholders stay."""
    return F.aggregate(
        F.coalesce(col(placeholders), F.array().cast("array<struct<placeholder:string,value:string>>")),
        col(text),
        lambda t, p: F.replace(t, p["placeholder"], p["value"]),
    )
