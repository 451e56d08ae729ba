"""JSON inside free text: balanced-object scan, strict lines, value access."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_STRING = r'"(?:[^"\\]++|\\.)*+"'
_PLAIN = r'[^{}"\\]++|\\.|' + _STRING


def _balanced_pattern(depth: int) -> str:
    """One object with at most `depth` levels of braces; every quantifier is
    possessive, so matching is linear and needs no stack per character."""
    pattern = r"\{(?:" + _PLAIN + r")*+\}"
    for _ in range(depth - 1):
        pattern = r"\{(?:" + _PLAIN + "|" + pattern + r")*+\}"
    return pattern


_BALANCED = _balanced_pattern(6)
_AT_START = r"(?s)\A" + _BALANCED
_WHOLE = r"(?s)\A" + _BALANCED + r"\z"
# Tokens of the exact scan: escape pair, string, brace, anything else.
_TOKENS = r'(?s)(\\.?|"(?:[^"\\]++|\\.)*+"?|[{}]|[^\\"{}]++)'

# Line ends and trailing white space as the producer's text rules see them.
# A pair of carriage return and line feed only adds an empty line, which holds no JSON.
LINE_BREAK = "[\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
_TRAILING_SPACE = "[\\s\\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]++\\z"


# Longer than any text, so that its length is not counted first.
_TO_THE_END = 2**31 - 1


def text_from(text: Column, position: Column) -> Column:
    return text.substr(position, F.lit(_TO_THE_END))


def balanced_end(raw: Column) -> Column:
    """Length of the object `raw` starts with, by scanning any depth; 0 when it never closes."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("offset"), F.lit(0).alias("end"))

    def step(state: Column, token: Column) -> Column:
        depth = state["depth"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        offset = state["offset"] + F.length(token)
        closes = (state["end"] == 0) & (token == "}") & (depth == 0)
        return F.struct(
            depth.alias("depth"),
            offset.alias("offset"),
            F.when(closes, offset).otherwise(state["end"]).alias("end"),
        )

    return F.aggregate(F.regexp_extract_all(raw, F.lit(_TOKENS), F.lit(1)), start, step, lambda s: s["end"])


def quick_object(raw: Column) -> Column:
    """The balanced object at the start of `raw` if its nesting is ordinary, else ''."""
    return F.regexp_extract(raw, _AT_START, 0)


def scanned_object(raw: Column) -> Column:
    """The balanced object at the start of `raw` at any depth, '' when it never closes."""
    return raw.substr(F.lit(1), balanced_end(raw))


def balanced_object(raw: Column, quick: Column | None = None) -> Column:
    """The balanced object at the start of `raw`, '' when it never closes.

    Strings and escapes are honoured. Ordinary nesting is one regex match, which
    may be passed in as a column computed before; the token scan runs only where
    that finds nothing.
    """
    found = quick_object(raw) if quick is None else quick
    return F.when(found != "", found).otherwise(scanned_object(raw))


def is_one_object(candidate: Column) -> Column:
    """The whole text is exactly one balanced object, nothing after it."""
    closes = candidate.endswith("}")
    return closes & (candidate.rlike(_WHOLE) | (balanced_end(candidate) == F.length(candidate)))


def parse_json(text: Column) -> Column:
    """Variant, or null when malformed. NaN and Infinity outside strings count as null values."""
    word = r'(?s)-?\b(?:NaN|Infinity)\b(?=(?:[^"\\]++|\\.|' + _STRING + r")*+\z)"
    has_word = text.contains("NaN") | text.contains("Infinity")
    return F.try_parse_json(F.when(has_word, F.regexp_replace(text, word, "null")).otherwise(text))


def value_text(doc: Column, path: str) -> Column:
    """Safe nested access as text; null when any step is missing, null or of another type."""
    return F.try_variant_get(doc, path, "string")


def truthy(doc: Column, path: str) -> Column:
    """Truth of a JSON value: false for missing, null, false, 0 and empty values."""
    shown = F.to_json(F.try_variant_get(doc, path, "variant"))
    empty = shown.isin("false", "null", '""', "{}", "[]") | shown.rlike(r"^-?0+(\.0*)?([eE][+-]?\d+)?$")
    return F.coalesce(~empty, F.lit(False))


def strict_json_lines(text: Column) -> Column:
    """Objects that have an `event` key, from lines that are pure JSON from their
    first brace on, in line order: array<struct<event, doc>>."""
    lines = F.split(text, LINE_BREAK)

    def trimmed(line: Column) -> Column:
        return F.when(line.endswith("}"), line).otherwise(F.regexp_replace(line, _TRAILING_SPACE, ""))

    candidates = F.transform(
        # The key can only be spelt plainly or with an escape.
        F.filter(lines, lambda line: line.contains('"event"') | line.contains("\\u")),
        lambda line: trimmed(F.when(line.startswith("{"), line).otherwise(text_from(line, F.locate("{", line)))),
    )
    strict = F.filter(candidates, lambda c: c.startswith("{") & is_one_object(c))
    # The key has to be one of the object itself, not of something inside it.
    docs = F.filter(F.transform(strict, parse_json), lambda doc: F.try_variant_get(doc, "$.event", "variant").isNotNull())
    return F.transform(
        docs,
        lambda doc: F.struct(value_text(doc, "$.event").alias("event"), doc.alias("doc")),
    )
