"""License scan with ordered signature rules, in DataFrame functions only.

Each text is reduced to lower-case words joined by one space. The words that are
keywords select the rules to try, so most texts meet no regex. Every match of a
selected rule is a detection with its character interval. Where one detection
holds another, the higher priority stays, then the longer, then the earlier rule.
Detections are resolved in one sweep by position, all inside the row: no shuffle,
no Python. Work grows with a text's length, not with its square.

Base phrases are counted apart from the rules: their places never suppress each other.

Defined cases: a null or empty text has no words, no places, empty labels and
score 0. Repeated rows are scanned one by one; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from logtrail.llm.license_rules import Rule, rules

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spaced_words(text: Column) -> Column:
    """' word word ... ' in lower case (A to Z only), or ' ' without a word."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), SEPARATORS, " ")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def rule_table(known: list[Rule]) -> Column:
    """Keyword -> its rules, as a literal map."""
    by_keyword: dict[str, list[Column]] = defaultdict(list)
    for number, rule in enumerate(known):
        by_keyword[rule.keyword].append(F.struct(
            F.lit(number).alias("number"), F.lit(rule.label).alias("label"), F.lit(rule.priority).alias("priority"),
            F.lit(rule.confidence).alias("confidence"), F.lit(f" (?:{rule.pattern})(?= )").alias("pattern"),
        ))
    return F.create_map(*[item for keyword, own in by_keyword.items() for item in (F.lit(keyword), F.array(*own))])


def _running(steps: Column) -> Column:
    """The steps with `stop` summed from the first on: the distance doubles each round, so no list grows by copies."""

    def add(state: Column, distance: Column) -> Column:
        further = F.transform(state, lambda x, i: F.struct(
            (x["stop"] + F.when(i >= distance, F.get(state, i - distance)["stop"]).otherwise(0)).alias("stop"), x["length"].alias("length")))
        return F.when(F.size(state) > distance, further).otherwise(state)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(31)]), steps, add)


def _intervals(text: Column, rule: Column) -> Column:
    """Detections of one rule: its matches with their places, from the pieces before them."""
    pieces = F.split(text, rule["pattern"], -1)
    matches = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    steps = F.filter(
        F.zip_with(pieces, matches, lambda piece, match: F.struct((F.length(piece) + F.length(match)).alias("stop"), F.length(match).alias("length"))),
        lambda step: step["length"].isNotNull(),  # behind the last match
    )
    return F.transform(_running(steps), lambda place: F.struct(
        (place["stop"] - place["length"]).alias("start"), (-place["stop"]).alias("minus_stop"), rule["number"].alias("number"),
        rule["label"].alias("label"), rule["priority"].alias("priority"), rule["confidence"].alias("confidence"),
    ))


def _holds(one: Column, other: Column) -> Column:
    return (one["start"] <= other["start"]) & (one["minus_stop"] <= other["minus_stop"])


def _beats(one: Column, other: Column) -> Column:
    same = _holds(one, other) & _holds(other, one)
    nested = _holds(one, other) | _holds(other, one)
    higher = nested & (one["priority"] > other["priority"])
    return higher | (
        (one["priority"] == other["priority"])
        & F.when(same, one["number"] < other["number"]).otherwise(_holds(one, other))
    )


def surviving(detections: Column) -> Column:
    """(labels, confidence) of the detections that no other one beats.

    A sweep by start. Only detections that reach beyond the current start are open,
    at most one of each rule; a beaten one stays open, since it can beat others.
    """
    none = F.array().cast("array<struct<minus_stop:int,start:int,number:int,label:string,priority:int,confidence:double,beaten:boolean>>")

    def marked(one: Column, beaten: Column) -> Column:
        return F.struct(*[one[c].alias(c) for c in ("minus_stop", "start", "number", "label", "priority", "confidence")], beaten.alias("beaten"))

    def settled(state: Column, done: Column) -> Column:
        left = F.filter(done, lambda d: ~d["beaten"])
        return F.struct(
            F.array_union(state["labels"], F.transform(left, lambda d: d["label"])).alias("labels"),
            F.greatest(state["confidence"], F.array_max(F.transform(left, lambda d: d["confidence"]))).alias("confidence"),
        )

    def step(state: Column, found: Column) -> Column:
        ended = F.exists(state["open"], lambda d: -d["minus_stop"] <= found["start"])
        done = settled(state, F.filter(state["open"], lambda d: -d["minus_stop"] <= found["start"]))
        still = F.filter(state["open"], lambda d: -d["minus_stop"] > found["start"])
        beaten = F.exists(state["open"], lambda d: _beats(d, found))
        return F.struct(
            F.concat(F.transform(still, lambda d: marked(d, d["beaten"] | _beats(found, d))), F.array(marked(found, beaten))).alias("open"),
            F.when(ended, done["labels"]).otherwise(state["labels"]).alias("labels"),
            F.when(ended, done["confidence"]).otherwise(state["confidence"]).alias("confidence"),
        )

    start = F.struct(none.alias("open"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("confidence"))
    return F.aggregate(F.array_sort(detections), start, step, lambda state: settled(state, state["open"]))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, places of the base phrases, labels and score."""
    known = rules()
    keywords = F.array(*[F.lit(keyword) for keyword in dict.fromkeys(rule.keyword for rule in known)])
    rows = docs.select(F.col(key).alias("key"), spaced_words(F.col(text)).alias("words"))
    rows = rows.select(
        "key", "words", F.greatest(_spaces(F.col("words")) - 1, F.lit(0)).cast("long").alias("n_words"),
        F.array_intersect(F.split("words", " "), keywords).alias("hits"),
    )
    phrases = {}
    for phrase in BASE_PHRASES:
        seen = F.contains("words", F.lit(f" {phrase} "))
        phrases[phrase] = F.when(seen, F.split("words", f" {phrase}(?= )", -1))
    rows = rows.select("key", "words", "n_words", "hits", *[pieces.alias(label) for (phrase, pieces), label in zip(phrases.items(), BASE_PHRASES.values())])
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE_PHRASES.items():
        pieces = F.col(f"`{label}`")
        behind = _spaces(F.element_at(pieces, -1)) - 1
        counts.append(F.when(pieces.isNotNull(), F.size(pieces) - 1).otherwise(0))
        firsts.append(_spaces(F.element_at(pieces, 1)))
        lasts.append(F.col("n_words") - behind - len(phrase.split()))
        labels.append(F.when(pieces.isNotNull(), F.lit(label)))
    table = rule_table(known)
    chosen = F.flatten(F.transform("hits", lambda keyword: F.element_at(table, keyword)))
    found = F.when(F.size("hits") > 0, surviving(F.flatten(F.transform(chosen, lambda rule: _intervals(F.col("words"), rule)))))
    rows = rows.select(
        "key", "n_words", sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"), found.alias("found"),
    )
    own = F.coalesce(F.col("found.labels"), F.array().cast("array<string>"))
    return rows.select(
        F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        F.greatest(F.coalesce(F.col("found.confidence"), F.lit(0.0)), F.when(F.size("base") > 0, 0.95).otherwise(0.0)).alias("score"),
    )


def op2_license_scan(documents: DataFrame) -> DataFrame:
    return scan(documents)
