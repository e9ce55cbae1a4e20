"""Private data replaced by surrogates.

Entities (mail addresses, telephone numbers, card and account numbers, network addresses,
identity numbers, secrets, and names after a form of address) get replacements of their
own kind, drawn by a keyed hash: digits for digits, letters of the same case, separators
and lengths kept; a card number is valid if the original was, an address has octets of the
same length, a name keeps its gender, taken from the form of address, and its script.
A name once met behind a form of address is known in the whole text: its parts are replaced
wherever they stand as a word there, before or after, with a capital or in capitals. In
lower case they are taken for other words.

The same entity has the same surrogate wherever it occurs, since the draw depends on the
key and the entity only; the parts of addresses and names are drawn by themselves, so that
a domain or a family name stays recognisable as the same. Over the whole corpus, surrogates
are checked against each other and against all real entities: of entities that drew the
same one, or a real one, all but one draw again, until every entity has its own. Only those
that had to draw again need a look at a table; for all others the key is enough.

Null texts stay null, texts without entities stay as they are. Repeated rows are replaced
alike. All rows and columns are kept, added columns get an underscore where a name is taken.
An empty table gives no rows. Without the key nobody can draw the surrogates again.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections.abc import Iterator
from string import ascii_lowercase

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.tables import free_name, with_fields, written

# Forms of address by gender.
MALE = ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н"]
FEMALE = [
    "Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora",
    "Señorita", "Sra", "Srta", "госпожа", "г-жа",
]
# Syllables of surrogate names by script, and how names of each gender end.
_SYLLABLES = {
    "latin": ("ba be da do fa ga ka la le li lo ma me mi na ne ni ra re ri ro sa se ta te ti va vi".split(), "n", "a"),
    "cyrillic": ("ба бе да до ка ла ле ли ма ми на не ни ра ре ро са се та те ва ви".split(), "н", "а"),
    "greek": ("βα δα θα κα λα λε μα μι να νε πα ρα ρο σα τα τε φι".split(), "ς", "α"),
}

#: After so many draws lengths may change, where short formats leave too few surrogates.
PATIENCE = 6

_PATTERNS = {
    "mail": r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}",
    "account": r"\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b",
    "secret": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:sk|pk|ghp|gho|xoxb)[-_][0-9A-Za-z_-]{16,}"
    r"|\b(?=[0-9a-f]*[a-f])(?=[a-f]*\d)[0-9a-f]{32,}\b|\b(?=[0-9A-F]*[A-F])(?=[A-F]*\d)[0-9A-F]{32,}\b",
    "identity": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-])",
    "telephone": r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\d)"
    r"|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "network": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
}
_NUMBERED = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in _PATTERNS.items() if kind != "mail"))
_MAIL = re.compile(_PATTERNS["mail"])
#: In every text that a numbered pattern matches: a digit, or what a secret may begin with.
_MAY_BE_NUMBERED = re.compile(r"\d|AKIA|ASIA|(?:sk|pk|ghp|gho|xoxb)[-_]")
_ADDRESSED = re.compile(
    rf"\b({'|'.join(sorted(MALE + FEMALE, key=len, reverse=True))})\.?[  ]"
    r"([^\W\d_a-z]['\w-]+(?: [^\W\d_a-z]['\w-]+){0,2})"
)
#: A word that may be part of a name: it begins with a capital.
_CAPITALISED = re.compile(r"(?<![\w'’-])[^\W\d_a-z][\w'’-]+")
_NAMES = ("given_m", "given_f", "family")
_POSSESSIVE = ("'s", "’s")


def _word(text: str, first: int, end: int) -> tuple[str, int]:
    """A word without its possessive ending, as names are known, and where it ends."""
    if end - first > 3 and text[first:end].endswith(_POSSESSIVE):
        end -= 2
    return text[first:end], end


def _names(text: str) -> list[tuple[str, int, int]]:
    """Parts of names behind forms of address, and the same words in the rest of the text."""
    found, known = [], {}
    for m in _ADDRESSED.finditer(text):
        parts = [p for p in re.finditer(r"\S+", m[2]) if p[0][0].isupper()]
        given = "given_m" if m[1] in MALE else "given_f"
        for k, part in enumerate(parts):
            kind = "family" if k == len(parts) - 1 else given
            first = m.start(2) + part.start()
            value, end = _word(text, first, m.start(2) + part.end())
            found.append((kind, first, end))
            # A word met as two kinds is, elsewhere, what it was first.
            known.setdefault(canonical(kind, value), kind)
    if not found:
        return found
    at = {first for _, first, _ in found}
    for m in _CAPITALISED.finditer(text):
        value, end = _word(text, m.start(), m.end())
        kind = known.get(canonical("family", value))
        if kind and m.start() not in at and len(value) > 1:
            found.append((kind, m.start(), end))
    return found


def entities(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, first, end) of each entity, in order, none inside another.

    A name's parts are entities of their own: ``given_m``, ``given_f`` and ``family``.
    """
    found: list[tuple[str, int, int]] = []
    if not text:
        return found
    if "@" in text:
        found += [("mail", m.start(), m.end()) for m in _MAIL.finditer(text)]
    if _MAY_BE_NUMBERED.search(text):
        found += [(m.lastgroup, m.start(), m.end()) for m in _NUMBERED.finditer(text)]
    found += _names(text)
    found.sort(key=lambda e: (e[1], -e[2]))
    kept: list[tuple[str, int, int]] = []
    for entity in found:
        if not kept or entity[1] >= kept[-1][2]:
            kept.append(entity)
    return kept


def canonical(kind: str, value: str) -> str:
    """What makes two spellings one entity."""
    if kind == "mail":
        return value.lower()
    if kind in ("card", "account", "telephone", "identity"):
        return re.sub(r"[^0-9A-Za-z+]", "", value)
    if kind in _NAMES:
        return value.capitalize()
    return value


class _Draws:
    """Numbers drawn by key and name, the same every time."""

    def __init__(self, key: bytes, *name: str):
        self._key, self._name, self._block, self._left = key, "\0".join(name), 0, b""

    def below(self, limit: int) -> int:
        if len(self._left) < 4:
            mark = f"{self._block}\0{self._name}".encode("utf-8", "surrogatepass")
            self._left, self._block = hmac.digest(self._key, mark, "sha256"), self._block + 1
        number, self._left = int.from_bytes(self._left[:4], "big"), self._left[4:]
        return number % limit


def _neighbour(draws: _Draws, letter: str) -> str:
    """A letter of the same kind from the same stretch of its script."""
    first = ord(letter) & ~31
    kind = unicodedata.category(letter)
    same = [chr(c) for c in range(first, first + 32) if unicodedata.category(chr(c)) == kind]
    return same[draws.below(len(same))]


def _widened(draws: _Draws, made: str, attempt: int, alphabet: str = "0123456789") -> str:
    """Longer after many draws, so that there is always a surrogate left."""
    more = max(0, attempt - PATIENCE + 1) // 2
    return made + "".join(alphabet[draws.below(len(alphabet))] for _ in range(more))


def _like(draws: _Draws, value: str, digits: str = "0123456789", letters: bool = True) -> str:
    """Characters of the same kind: digits, letters of the same case; others as they are."""
    made = []
    for c in value:
        if c.isdigit():
            made.append(digits[draws.below(len(digits))])
        elif letters and c.isascii() and c.isalpha():
            made.append(chr((65 if c.isupper() else 97) + draws.below(26)))
        elif letters and c.isalpha():
            made.append(_neighbour(draws, c))
        else:
            made.append(c)
    return "".join(made)


def luhn_rest(digits: str) -> int:
    """Zero for a valid card number."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        double = int(c) * (1 + k % 2)
        total += double - 9 if double > 9 else double
    return total % 10


def _card(draws: _Draws, number: str) -> str:
    valid = luhn_rest(number) == 0
    made = number[0] + _like(draws, number[1:-1])
    check = (10 - luhn_rest(made + "0")) % 10
    return made + str(check if valid else (check + 1 + draws.below(9)) % 10)


def _account(draws: _Draws, number: str) -> str:
    body = _like(draws, number[4:])
    spread = "".join(str(int(c, 36)) for c in body + number[:2] + "00")
    return f"{number[:2]}{98 - int(spread) % 97:02d}{body}"


def _octet(draws: _Draws, octet: str, wide: bool) -> str:
    low, high = (1, 254) if wide else {1: (1, 9), 2: (10, 99)}.get(len(octet), (100, 254))
    return str(low + draws.below(high - low + 1))


def _script(value: str) -> str:
    if any("Ѐ" <= c <= "ӿ" for c in value):
        return "cyrillic"
    return "greek" if any("Ͱ" <= c <= "Ͽ" for c in value) else "latin"


def _name(draws: _Draws, kind: str, value: str, attempt: int) -> str:
    syllables, male, female = _SYLLABLES[_script(value)]
    wanted = max(3, len(value) - 1) + attempt // PATIENCE
    made = ""
    while len(made) < wanted:
        made += syllables[draws.below(len(syllables))]
    made += {"given_m": male, "given_f": female}.get(kind, syllables[draws.below(len(syllables))])
    if kind == "given_m" and made[-2:] == female:
        made += male
    return made.capitalize()


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of a canonical entity, in its canonical form."""
    draws = _Draws(key, kind, entity, str(attempt))
    if kind == "mail":
        local, _, domain = entity.rpartition("@")
        labels = domain.split(".")
        # A domain keeps its own draw, so that two addresses of one domain stay so.
        site = _like(_Draws(key, "domain", domain), ".".join(labels[:-1]))
        return f"{_widened(draws, _like(draws, local), attempt, ascii_lowercase)}@{site}.{labels[-1]}"
    if kind == "card":
        return _widened(draws, _card(draws, entity), attempt)
    if kind == "account":
        return _widened(draws, _account(draws, entity), attempt)
    if kind == "network":
        made = ".".join(_octet(draws, o, attempt >= PATIENCE) for o in entity.split("."))
        # All addresses are four octets; only a corpus that holds most of them gets here.
        return _widened(draws, made, attempt - 4 * PATIENCE)
    if kind == "telephone":
        # The country code stays; without one, all digits change.
        code = 2 if entity.startswith("+") else 0
        return entity[:code] + _widened(draws, _like(draws, entity[code:]), attempt)
    if kind == "secret":
        kept = re.match(r"AKIA|ASIA|(?:sk|pk|ghp|gho|xoxb)[-_]|", entity)[0]
        rest = entity[len(kept) :]
        if re.fullmatch("[0-9a-f]+|[0-9A-F]+", entity):
            made = "".join("0123456789abcdef"[draws.below(16)] for _ in rest)
            made = _widened(draws, made, attempt, "0123456789abcdef")
            return made.upper() if rest.isupper() else made
        return kept + _widened(draws, _like(draws, rest), attempt)
    if kind == "identity":
        return _widened(draws, _like(draws, entity), attempt)
    return _name(draws, kind, entity, attempt)


def _spelled(kind: str, value: str, made: str) -> str:
    """The surrogate with the separators and the case of this spelling."""
    if kind == "mail":
        return "".join(m.upper() if c.isupper() else m for c, m in zip(value, made)) + made[len(value) :]
    if kind in ("card", "account", "telephone", "identity"):
        rest = iter(made)
        spelled = "".join(next(rest) if re.match(r"[0-9A-Za-z+]", c) else c for c in value)
        return spelled + "".join(rest)
    if kind in _NAMES and len(value) > 1 and value.isupper():
        return made.upper()
    return made


def replaced(
    key: bytes, text: str | None, attempts: dict[tuple[str, str], int]
) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with surrogates, and (kind, first, end) of each in it."""
    parts, places, at, size = [], [], 0, 0
    for kind, first, end in entities(text):
        value = text[first:end]
        entity = canonical(kind, value)
        made = _spelled(kind, value, surrogate(key, kind, entity, attempts.get((kind, entity), 0)))
        parts += [text[at:first], made]
        size += first - at
        places.append((kind, size, size + len(made)))
        at, size = end, size + len(made)
    if not places:
        return text, places
    return "".join([*parts, text[at:]]), places


def _drawn(entities_of: DataFrame, key: bytes) -> DataFrame:
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, attempts = (c.to_pylist() for c in batch.columns)
            made = [surrogate(key, *entity) for entity in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], ["kind", "entity", "attempt", "made"]
            )

    columns = entities_of.select("kind", "entity", "attempt")
    return columns.mapInArrow(draw, "kind string, entity string, attempt int, made string")


def distinct_draws(known: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt): the entities that had to draw again, and how often.

    A surrogate belongs to the entity that drew it in the earliest round, then the least;
    whoever drew a real entity or another's surrogate draws again.
    """
    settled, asking = None, known.select("kind", "entity", F.lit(0).alias("attempt"))
    real = known.select("kind", F.col("entity").alias("made"), F.lit(True).alias("real"))
    attempt = 0
    while True:
        drawn = _drawn(asking, key)
        held = drawn if settled is None else drawn.unionByName(settled)
        first = held.groupBy("kind", "made").agg(F.min(F.struct("attempt", "entity")).alias("first"))
        judged = (
            held.where(F.col("attempt") == attempt)
            .join(first, ["kind", "made"])
            .join(real, ["kind", "made"], "left")
            .withColumn("own", (F.col("first")["entity"] == F.col("entity")) & F.col("real").isNull())
        )
        round_of = written(judged.select("kind", "entity", "attempt", "made", "own"), "surrogates")
        done = round_of.where("own").drop("own")
        settled = done if settled is None else settled.unionByName(done)
        again = round_of.where("NOT own")
        if again.limit(1).count() == 0:
            return settled.where("attempt > 0").drop("made")
        attempt += 1
        asking = again.select("kind", "entity", F.lit(attempt).alias("attempt"))


def with_surrogates(documents: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents with surrogates in their text, and ``entities``: kind and place of each."""
    row = free_name(documents, "_row")
    keyed = documents.withColumn(row, F.xxhash64(text))

    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kinds, values = [], [], []
            for mark, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = {(k, canonical(k, content[a:b])) for k, a, b in entities(content)}
                for kind, entity in sorted(seen):
                    rows.append(mark)
                    kinds.append(kind)
                    values.append(entity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                ["row", "kind", "entity"],
            )

    occurrences = written(
        keyed.select(row, text).mapInArrow(occurring, "row long, kind string, entity string"),
        "entities",
    )
    again = distinct_draws(occurrences.select("kind", "entity").distinct(), key)
    changes = written(
        occurrences.join(again, ["kind", "entity"])
        .groupBy("row")
        .agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("again")),
        "drawn-again",
    )
    of, drawn = free_name(documents, "_of"), free_name(documents, "_again")
    changes = changes.withColumnsRenamed({"row": of, "again": drawn})
    joined = keyed.join(changes, F.col(row) == F.col(of), "left").select(*documents.columns, drawn)
    name, names = free_name(documents, "entities"), documents.columns
    place = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("first", T.IntegerType()),
            T.StructField("last", T.IntegerType()),
        ]
    )
    kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, other = (batch.schema.get_field_index(n) for n in (text, drawn))
            texts, places = [], []
            for content, again_of in zip(batch.column(at).to_pylist(), batch.column(other).to_pylist()):
                attempts = {(e["kind"], e["entity"]): e["attempt"] for e in again_of or []}
                made, found = replaced(key, content, attempts)
                texts.append(made)
                places.append([{"kind": k, "first": a, "last": b} for k, a, b in found])
            columns = [c for i, c in enumerate(batch.columns) if i != other]
            columns[at if at < other else at - 1] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(places, kind)], [*names, name]
            )

    return joined.mapInArrow(replace, with_fields(documents, **{name: T.ArrayType(place)}))


def surrogate_digest(replaced_rows: DataFrame) -> DataFrame:
    """One row for each document: its new text and what was replaced in it."""
    return replaced_rows.select(
        "doc_id",
        "text",
        F.size("entities").cast("long").alias("n_replaced"),
        F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))).alias("kinds"),
        "entities",
    )
