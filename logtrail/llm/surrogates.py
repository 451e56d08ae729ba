"""Personal data: detect entities and put keyed, type-consistent surrogates in their place.

Kinds: e-mail address, telephone number, IPv4 address, payment card, IBAN, secret
(a long hexadecimal or base64 value behind a word such as token or key), and
names behind a title. A surrogate is drawn from HMAC(key, kind, canonical form,
attempt): digits become digits, letters letters of the same case and script, hex
digits hex digits; a card or IBAN that has a valid checksum gets a valid one; an
address keeps its number range; a name part is replaced from a list of the same
gender and script. The canonical form drops punctuation and case, so one entity
written in two formats has one surrogate written in both formats (coreference);
name parts are entities of their own, and inside a text a part that was seen
behind a title is replaced wherever it stands capitalised or in capitals.

Telephone numbers are groups of digits, 8 to 15 in all, with a country code, a
leading 0 or an area code in parentheses; without any of these, the North American
and Spanish groupings. Dates are none. Name parts hold inner capitals and
apostrophes. Not found: nine digits in one run without a mark, parts in small
letters (von, de la), initials and titles in capitals or missing in TITLES.

One first name is one entity, whatever title it stands behind: its gender is the one
that more texts of the corpus give it, and open where they tie or none does.

Collision check: all distinct entities of the corpus get their surrogate of attempt
0. While two entities of a kind share a surrogate, or a surrogate equals an entity
of the corpus, all but the smallest of the former and all of the latter go to the
next attempt; first names of all genders are one kind here. A format that runs out
of values gets longer ones: one more character after every LONGER_AFTER attempts, and
for an IPv4 address an IPv6 one. The few entities with another attempt than 0, or
another gender than their title says, are joined to the documents that hold them;
everything else is computed in place.

Defined cases: null text stays null, empty text empty, without entities a text is
returned unchanged. An e-mail address, a secret and a name have no greatest length:
each is taken to its end. Where entities overlap, the earlier, then the longer, then
the kind listed first is taken. Repeated rows are treated alike; other columns
are kept as they are by `replace_in`.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtrail.llm.common import batches, prepare
from logtrail.session import write_stage

LONGER_AFTER = 16
MALE, FEMALE, ANY = "male", "female", "any"
FIRST = "name-first"
# Titles by gender (fixed words of the language, matched as written).
TITLES = {
    MALE: ["Mr", "Mister", "Sir", "Lord", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н", "κύριος"],
    FEMALE: ["Mrs", "Ms", "Miss", "Lady", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Sra", "госпожа", "г-жа", "κυρία"],
    ANY: ["Dr", "Prof", "Professor", "Doctor", "Docteur", "доктор"],
}
# First names by script and gender, and surnames by script; the surrogate of a name part comes from here.
FIRST_NAMES = {
    ("latin", MALE): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Noah", "Oscar", "Paul", "Robert", "Simon", "Thomas", "Victor"],
    ("latin", FEMALE): ["Alma", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Ines", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula", "Rosa", "Sofia", "Teresa", "Vera"],
    ("cyrillic", MALE): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Кирилл", "Лев", "Максим", "Павел"],
    ("cyrillic", FEMALE): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"],
    ("greek", MALE): ["Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
    ("greek", FEMALE): ["Άννα", "Ελένη", "Ιωάννα", "Μαρία", "Σοφία"],
}
SURNAME_PARTS = {
    "latin": (["Al", "Ber", "Cor", "Dal", "Eck", "Fal", "Gar", "Hol", "Lan", "Mor", "Nor", "Ros", "Sal", "Tor", "Var", "Wel"],
              ["ba", "de", "fi", "ga", "li", "ma", "ne", "ri", "sa", "ti"], ["den", "ford", "ler", "man", "nard", "ner", "ran", "sen", "ton", "well"]),
    "cyrillic": (["Бар", "Вол", "Гор", "Дан", "Кар", "Лев", "Мор", "Сол"], ["а", "е", "и", "о"], ["ков", "лин", "нов", "ров", "син"]),
    "greek": (["Αλ", "Βασ", "Δημ", "Καρ", "Μαρ", "Παπ"], ["α", "ι", "ο"], ["δης", "κης", "λος", "πουλος"]),
}
# A letter that is no small one, then letters; a capital may follow an apostrophe, save the S of a genitive. The word ends behind it.
_CAPITAL = r"[^\W\d_" + "".join(c for c in map(chr, range(0x530)) if c.islower()) + "]"
_NAME = rf"{_CAPITAL}(?:[^\W\d_]++|(?=['’]))(?:['’](?![Ss](?!\w)){_CAPITAL}[^\W\d_]*+)*+(?!\w)"
# Between the digit groups of a telephone number; the blanks are also those that do not break.
_GAP = r"(?: ?[/–-] ?|[ .\u00a0\u202f])"
_GROUPS = rf"(?:{_GAP}\d{{1,8}}+)"
_PHONES = [
    rf"\+\d{{1,8}}+(?:{_GAP}?\(\d{{1,5}}\){_GAP}?\d{{1,8}}+)?{_GROUPS}{{0,5}}(?!\w)",  # with a country code
    rf"00[1-9]\d{{0,2}}+(?:{_GAP}?\(\d{{1,5}}\){_GAP}?\d{{1,8}}+)?{_GROUPS}{{1,5}}(?!\w)",
    rf"0\d{{1,7}}+{_GROUPS}{{1,4}}(?!\w)",  # with a leading 0
    rf"\((?:0\d{{0,4}}|[1-9]\d{{1,2}})\){_GAP}?\d{{1,8}}+{_GROUPS}{{0,4}}(?!\w)",
    r"(?:\+\d{8,15}|0[1-9]\d{8,10}|00[1-9]\d{8,12})(?!\w)",
    rf"(?:[6-9]\d\d(?:{_GAP}\d\d){{3}}|[89]\d{_GAP}\d{{3}}(?:{_GAP}\d\d){{2}})(?!\w)",  # Spanish, no mark but the form
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-]|\.\d)",
]
_DATE = re.compile(r"(?:0[1-9]|[12]\d|3[01])([ ./-])(?:0[1-9]|[12]\d|3[01])\1(?:19|20)\d\d(?!\d)")
_TITLE = "|".join(sorted((re.escape(t) for group in TITLES.values() for t in group), key=len, reverse=True))
PATTERNS = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]++@(?:[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+\.)+[A-Za-z]{2,}+(?![\w@])"),
    "secret": re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|key)[\"']?\s*+[:=]\s*+[\"']?(?P<value>[A-Za-z0-9+/_-]{12,}+={0,2})"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\w)"),
    "phone": re.compile(rf"(?<![\w.])(?=[+(\d])(?:{'|'.join(_PHONES)})"),
    "name": re.compile(rf"(?<!\w)(?P<title>{_TITLE})\.?\s(?P<value>{_NAME}(?:[ -]{_NAME})*+)"),
}
#: A text without any of these characters or words holds no entity of the pattern.
_NEEDS = {"email": ("@",), "ip": (".",)}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def script_of(text: str) -> str:
    for char in text:
        if "Ѐ" <= char <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= char <= "Ͽ" or "ἀ" <= char <= "῿":
            return "greek"
    return "latin"


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, stop, kind, canonical form) of the entities, in order, without overlap."""
    if not text:
        return []
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        if kind in _NEEDS and not all(need in text for need in _NEEDS[kind]):
            continue
        if kind == "phone":
            found += [(a, b, order, kind, canonical(kind, text[a:b])) for a, b in _phones(text)]
            continue
        for match in pattern.finditer(text):
            if kind == "name":
                found += [(a, b, order, k, c) for a, b, k, c in _name_parts(match)]
                continue
            start, stop = match.span("value") if kind == "secret" else match.span()
            value = text[start:stop]
            if kind == "card" and not luhn(re.sub(r"\D", "", value)) and len(re.sub(r"\D", "", value)) != 16:
                continue
            if kind == "iban" and not iban_valid(value.replace(" ", "")):
                continue
            found.append((start, stop, order, kind, canonical(kind, value)))
    names = {c: (k, o) for a, b, o, k, c in found if k.startswith("name")}
    if names:
        known = {c.upper(): (k, o, c) for c, (k, o) in names.items()} | {c: (k, o, c) for c, (k, o) in names.items()}
        again = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, known), key=len, reverse=True)) + r")(?!\w)")
        for match in again.finditer(text):
            kind, order, own = known[match[0]]
            found.append((match.start(), match.end(), order, kind, own))
    found.sort(key=lambda e: (e[0], -e[1], e[2]))
    out, end = [], 0
    for start, stop, _, kind, form in found:
        if start >= end:
            out.append((start, stop, kind, form))
            end = stop
    return out


def _phones(text: str):
    """Spans of 8 to 15 digits; of more, the last groups are left, and looked at again. Dates are none."""
    place = 0
    while match := PATTERNS["phone"].search(text, place):
        start, place = match.span()
        if date := _DATE.match(text, start):
            place = date.end()
            continue
        ends, digits = [], 0
        for group in re.finditer(r"\d+", match[0]):
            digits += len(group[0])
            if 8 <= digits <= 15:
                ends.append(start + group.end())
        if ends:
            place = ends[-1]
            yield start, place


def _name_parts(match: re.Match) -> list[tuple[int, int, str, str]]:
    gender = next(g for g, titles in TITLES.items() if match["title"] in titles)
    spans = [(m.start() + match.start("value"), m.end() + match.start("value")) for m in re.finditer(_NAME, match["value"])]
    out = []
    for place, (start, stop) in enumerate(spans):
        first = place < len(spans) - 1
        text = canonical("name", match.string[start:stop])
        kind = f"name-first-{_gender(text, gender)}" if first else "name-last"
        out.append((start, stop, kind, text))
    return out


def _gender(name: str, by_title: str) -> str:
    if by_title != ANY:
        return by_title
    for (_, gender), names in FIRST_NAMES.items():
        if name in names:
            return gender
    return ANY


def canonical(kind: str, value: str) -> str:
    if kind in ("card", "phone"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "name":
        return value.title() if value.isupper() else value
    return value.lower() if kind == "email" else value


class _Stream:
    """Numbers drawn from HMAC-SHA256 of key, kind, form and attempt."""

    def __init__(self, key: bytes, kind: str, form: str, attempt: int):
        self.key, self.seed, self.block, self.bits, self.left = key, f"{kind}\0{attempt}\0{form}".encode(), 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < 32:
            made = hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block, self.bits, self.left = self.block + 1, int.from_bytes(made, "big"), 256
        value = self.bits & 0xFFFFFFFF
        self.bits >>= 32
        self.left -= 32
        return value % n


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _like(text: str, draw: _Stream) -> str:
    out = []
    for char in text:
        for pool in (_DIGITS, _LOWER, _UPPER):
            if char in pool:
                char = pool[draw.below(len(pool))]
                break
        else:
            if char.isalpha():
                char = _other_letter(char, draw)
        out.append(char)
    return "".join(out)


def _other_letter(char: str, draw: _Stream) -> str:
    """A letter of the same script block and case."""
    base = ord(char) & ~0x1F
    pool = [c for c in map(chr, range(base, base + 32)) if c.isalpha() and c.isupper() == char.isupper() and c.islower() == char.islower()]
    return pool[draw.below(len(pool))]


def surrogate(key: bytes, kind: str, form: str, attempt: int = 0) -> str:
    """Canonical form of the surrogate of an entity given by its canonical form."""
    draw = _Stream(key, kind, form, attempt)
    more = "0" * (attempt // LONGER_AFTER)
    if kind == "email":
        local, domain = form.rsplit("@", 1)
        labels = domain.split(".")
        longer = "".join(_LOWER[draw.below(26)] for _ in range(attempt // 4))  # short forms run out
        return f"{_like(local, draw)}{longer}@{'.'.join([_like(label, draw) for label in labels[:-1]] + labels[-1:])}"
    if kind == "ip":
        if more:
            return ":".join(["fd00", *(f"{draw.below(1 << 16):x}" for _ in range(7))])
        if attempt >= 4:  # addresses of the same number lengths run out
            return ".".join(str(draw.below(256)) for _ in range(4))
        return ".".join(str(_octet(part, draw)) for part in form.split("."))
    if kind == "card":
        body = form[0] + _like(form[1:-1] + more, draw)
        return next(body + d for d in _DIGITS if luhn(body + d) == luhn(form)) if luhn(form) else body + _like(form[-1], draw)
    if kind == "phone":
        kept = 2 if form.startswith("00") else 1 if form[0] == "0" else max(0, min(3, len(form) - 10))  # zeros or country code
        return form[:kept] + _like(form[kept:] + more, draw)
    if kind == "iban":
        body = _like(form[4:] + more, draw)
        rest = int("".join(str(int(c, 36)) for c in body + form[:2] + "00")) % 97
        return f"{form[:2]}{98 - rest:02d}{body}"
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", form):
            return "".join("0123456789abcdef"[draw.below(16)] for _ in form + more)
        if re.fullmatch(r"[0-9A-F]+", form):
            return "".join("0123456789ABCDEF"[draw.below(16)] for _ in form + more)
        return _like(form + more, draw)
    script = script_of(form)
    family = lambda: "".join(parts[draw.below(len(parts))] for parts in SURNAME_PARTS[script])
    if kind == "name-last":
        made = "-".join(family() for _ in range(1 + attempt // 2))
    else:
        gender = kind.rsplit("-", 1)[1]
        pool = [n for (s, g), names in FIRST_NAMES.items() if s == script and gender in (g, ANY) for n in names]
        made = "-".join(pool[draw.below(len(pool))] for _ in range(1 + attempt))  # a list is finite: double names
    return made


def _octet(part: str, draw: _Stream) -> int:
    low, high = ((0, 9), (10, 99), (100, 255))[len(part) - 1]
    return low + draw.below(high - low + 1)


def laid_out(kind: str, value: str, made: str) -> str:
    """The surrogate's canonical form written the way the mention is."""
    if kind in ("card", "phone", "iban"):
        chars = iter(made)
        return "".join([*(next(chars) if c.isalnum() else c for c in value), *chars])
    if kind == "email":
        return "".join(m.upper() if v.isupper() else m for v, m in zip_longest(value[: len(made)], made, fillvalue=""))
    return made.upper() if kind.startswith("name") and value.isupper() else made


def replaced(text: str | None, key: bytes, settled: dict[tuple[str, str], tuple[str, int]]) -> tuple[str | None, list[dict]]:
    """The text with surrogates, and the entities with their places in the old text.

    `settled` holds the kind and attempt of the entities that keep not their own kind at attempt 0.
    """
    entities, parts, end = [], [], 0
    for start, stop, kind, form in detect(text or ""):
        own, attempt = settled.get((kind, form), (kind, 0))
        made = laid_out(kind, text[start:stop], surrogate(key, own, form, attempt))
        parts += [text[end:start], made]
        entities.append({"kind": kind, "start": start, "stop": stop, "surrogate": made})
        end = stop
    return ("".join([*parts, text[end:]]) if parts else text), entities


def _mentions(rows: DataFrame) -> DataFrame:
    """mark of the text, kind, form of each entity in it."""

    def find(source):
        for batch in batches(source):
            out = [(m, k, f) for m, t in zip(batch.column("mark").to_pylist(), batch.column("text").to_pylist()) for k, f in {e[2:] for e in detect(t or "")}]
            marks, kinds, forms = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.int64()), pa.array(kinds, pa.string()), pa.array(forms, pa.string())], ["mark", "kind", "form"])

    return rows.mapInArrow(find, "mark long, kind string, form string")


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """domain, kind, form, attempt -> the same and made."""

    def make(source):
        for batch in batches(source):
            held = batch.select(["domain", "kind", "form", "attempt"])
            made = [surrogate(key, k, f, a) for _, k, f, a in zip(*(c.to_pylist() for c in held.columns))]
            yield pa.RecordBatch.from_arrays([*held.columns, pa.array(made, pa.string())], ["domain", "kind", "form", "attempt", "made"])

    return entities.select("domain", "kind", "form", "attempt").mapInArrow(make, "domain string, kind string, form string, attempt int, made string")


def _one_gender(votes: DataFrame) -> DataFrame:
    """domain, form, kind: each first name once, of the gender that most texts give it."""
    texts = {gender: F.sum(F.when(F.col("kind") == f"name-first-{gender}", F.col("texts")).otherwise(0)) for gender in (MALE, FEMALE)}
    more = texts[MALE] - texts[FEMALE]
    gender = F.when(more > 0, MALE).when(more < 0, FEMALE).otherwise(ANY)
    return votes.groupBy("domain", "form").agg(
        F.when(F.col("domain") == FIRST, F.concat(F.lit(f"{FIRST}-"), gender)).otherwise(F.min("kind")).alias("kind"))


def settle(mentions: DataFrame, key: bytes) -> DataFrame:
    """kind (as mentioned), form, own (the kind it is of), attempt: the entities that keep not their own kind at attempt 0."""
    domain = F.when(F.col("kind").startswith(FIRST), FIRST).otherwise(F.col("kind"))
    votes = write_stage(mentions.groupBy("kind", "form").agg(F.count(F.lit(1)).alias("texts")).withColumn("domain", domain), "votes")
    table = write_stage(_with_surrogates(_one_gender(votes).withColumn("attempt", F.lit(0)), key), "surrogates")
    while True:
        owner = table.groupBy("domain", F.col("made").alias("taken")).agg(F.min("form").alias("owner"))
        real = table.select("domain", F.col("form").alias("taken"), F.lit(True).alias("real"))
        checked = (
            table.withColumn("taken", F.col("made")).join(owner, ["domain", "taken"]).join(real, ["domain", "taken"], "left")
            .select("domain", "kind", "form", "attempt", "made", ((F.col("owner") != F.col("form")) | F.coalesce("real", F.lit(False))).alias("again"))
        )
        checked = write_stage(checked, "checked")
        if checked.where("again").limit(1).count() == 0:
            break
        moved = _with_surrogates(checked.where("again").withColumn("attempt", F.col("attempt") + 1), key)
        table = write_stage(checked.where("NOT again").drop("again").union(moved), "surrogates")
    found = table.select("domain", "form", F.col("kind").alias("own"), "attempt")
    return votes.join(found, ["domain", "form"]).where("attempt > 0 OR own != kind").select("kind", "form", "own", "attempt")


def _marked(docs: DataFrame, text: str) -> tuple[DataFrame, str]:
    """The rows with a hash of their text in a column whose name is free."""
    name = "mark"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.xxhash64(F.col(text))), name


def replace_in(docs: DataFrame, key: bytes, text: str = "text", entities: str | None = None) -> DataFrame:
    """All rows and columns, with surrogates in the text column; `entities` names a column to add."""
    prepare(docs.sparkSession)
    rows, mark = _marked(docs, text)
    mentions = write_stage(_mentions(rows.select(F.col(mark).alias("mark"), F.col(text).alias("text"))), "mentions")
    later = write_stage(settle(mentions, key), "settled")
    special = bool(later.limit(1).count())
    if special:
        pairs = mentions.join(later, ["kind", "form"]).select("mark", F.struct("kind", "form", "own", "attempt").alias("one")).distinct()
        exceptions = pairs.groupBy("mark").agg(F.collect_list("one").alias("exceptions")).withColumnRenamed("mark", f"{mark}of")
        rows = rows.join(exceptions, F.col(mark) == F.col(f"{mark}of"), "left").drop(f"{mark}of")
    place, names = docs.columns.index(text), docs.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ([f"`{entities}` array<struct<kind:string,start:int,stop:int,surrogate:string>>"] if entities else []))
    kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("surrogate", pa.string())]))

    def swap(source):
        for batch in batches(source):
            settled = batch.column(len(names) + 1).to_pylist() if special else [None] * batch.num_rows
            done = [
                replaced(value, key, {(e["kind"], e["form"]): (e["own"], e["attempt"]) for e in own or ()})
                for value, own in zip(batch.column(place).to_pylist(), settled)
            ]
            columns = batch.columns[: len(names)]
            columns[place] = pa.array([t for t, _ in done], pa.string())
            if entities:
                columns.append(pa.array([e for _, e in done], kind_of))
            yield pa.RecordBatch.from_arrays(columns, [*names, entities] if entities else names)

    return rows.mapInArrow(swap, schema)


# The key of the registered query and the pipeline; a real run takes its own from a secret store.
DEMONSTRATION_KEY = b"logtrail surrogates"


def op5_surrogates(documents: DataFrame) -> DataFrame:
    """doc_id, text with surrogates, entities with their places in the old text."""
    return replace_in(documents.select("doc_id", "text"), DEMONSTRATION_KEY, entities="entities").withColumn(
        "n_entities", F.size("entities").cast("long"))
