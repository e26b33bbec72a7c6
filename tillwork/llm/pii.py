"""Surrogates for personal data: keyed, of the same type and format, the same for the same entity.

Entities are found by patterns (mail and network addresses, phone and card numbers, account
numbers, access keys, secrets in assignments, and names after a title). A value is
read as digits of mixed bases by its format: digits stay digits, letters stay letters of
their script and case, vowels stay vowels, given names are exchanged within the list of their
script and gender, and separators, country codes, card issuers and name endings stay. The
surrogate is the value's successor in a keyed order of all values of that
format (a Feistel network over HMAC, walked until it lands inside), so no value is its own surrogate,
different values get different surrogates and the same value always gets the same, in every document and on
every executor, without a table of replacements. Card numbers keep a valid check
digit and addresses stay public or private. ``check_distinct`` proves it for a corpus: it counts
the values per surrogate over all entities found, and those that stayed as they were.

Null texts stay null, texts without entities come back unchanged. Rows are rewritten
one by one, so repeated rows stay equal.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwork import session
from tillwork.llm.common import slices

# Titles and given names by script and gender.
TITLES = {
    ("latin", "f"): ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora"),
    ("latin", "m"): ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor"),
    ("latin", ""): ("Dr", "Prof"),
    ("cyrillic", "f"): ("госпожа", "Госпожа"),
    ("cyrillic", "m"): ("господин", "Господин"),
    ("greek", "f"): ("κυρία", "Κυρία"),
    ("greek", "m"): ("κύριος", "Κύριος"),
}
GIVEN = {
    ("latin", "f"): (
        "Agnes", "Alice", "Amanda", "Ana", "Andrea", "Angela", "Anna", "Anne", "Barbara", "Beatrice", "Bianca", "Brigitte",
        "Camille", "Carla", "Carmen", "Caroline", "Catherine", "Cecilia", "Charlotte", "Chiara", "Christine", "Clara",
        "Claire", "Cristina", "Diana", "Dorothy", "Elena", "Elisabeth", "Elizabeth", "Emily", "Emma", "Eva", "Francesca",
        "Frida", "Greta", "Hannah", "Helen", "Ines", "Ingrid", "Isabel", "Jane", "Jennifer", "Julia", "Karen", "Katharina",
        "Laura", "Linda", "Lucia", "Margaret", "Maria", "Marie", "Marta", "Martha", "Mary", "Monika", "Nina", "Olivia",
        "Patricia", "Paula", "Rachel", "Rosa", "Ruth", "Sabine", "Sarah", "Silvia", "Sofia", "Susan", "Teresa"),
    ("latin", "m"): (
        "Adam", "Albert", "Alexander", "Andrew", "Anthony", "Antonio", "Arthur", "Benjamin", "Bernard", "Carlos",
        "Charles", "Christian", "Daniel", "David", "Diego", "Edward", "Emil", "Erik", "Fabian", "Felix", "Fernando",
        "Francisco", "Frank", "Frederic", "Georg", "George", "Giovanni", "Hans", "Henry", "Hugo", "Ivan", "Jacob",
        "James", "Javier", "John", "Jorge", "Joseph", "Juan", "Karl", "Klaus", "Louis", "Luca", "Luis", "Manuel",
        "Marco", "Mark", "Martin", "Matthew", "Max", "Michael", "Miguel", "Nicolas", "Oliver", "Oscar", "Pablo",
        "Patrick", "Paul", "Pedro", "Peter", "Philip", "Pierre", "Rafael", "Richard", "Robert", "Samuel", "Stefan",
        "Steven", "Thomas", "Victor", "Walter", "William"),
    ("cyrillic", "f"): (
        "Александра", "Алина", "Анастасия", "Анна", "Валентина", "Варвара", "Вера", "Виктория", "Галина", "Дарья",
        "Екатерина", "Елена", "Ирина", "Ксения", "Лариса", "Людмила", "Марина", "Мария", "Надежда", "Наталья", "Нина",
        "Оксана", "Ольга", "Полина", "Светлана", "София", "Тамара", "Татьяна", "Юлия"),
    ("cyrillic", "m"): (
        "Александр", "Алексей", "Анатолий", "Андрей", "Антон", "Борис", "Вадим", "Василий", "Виктор", "Владимир",
        "Георгий", "Григорий", "Дмитрий", "Евгений", "Иван", "Игорь", "Илья", "Кирилл", "Константин", "Максим",
        "Михаил", "Николай", "Олег", "Павел", "Пётр", "Роман", "Сергей", "Степан", "Фёдор", "Юрий"),
    ("greek", "f"): (
        "Άννα", "Αγγελική", "Αικατερίνη", "Αλεξάνδρα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ελένη", "Ειρήνη", "Ευαγγελία",
        "Ιωάννα", "Κωνσταντίνα", "Μαρία", "Παναγιώτα", "Σοφία", "Χριστίνα"),
    ("greek", "m"): (
        "Αθανάσιος", "Αλέξανδρος", "Ανδρέας", "Αντώνης", "Βασίλης", "Γιάννης", "Γιώργος", "Δημήτρης", "Κώστας",
        "Μιχάλης", "Νίκος", "Παναγιώτης", "Παύλος", "Πέτρος", "Σπύρος", "Χρήστος"),
}
LETTERS = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóú", "àèìòù", "äöü",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ",
)

_WORD = r"[^\W\d_]+"
_TITLE = "|".join(sorted({t for names in TITLES.values() for t in names}, key=len, reverse=True))
_CAPITAL = r"[^\W\d_a-zа-яα-ω]"
_PART = rf"{_CAPITAL}(?:[^\W\d_]+(?:['’][^\W\d_]{{2,}})*|['’][^\W\d_]{{2,}})"
_INITIALS = rf"(?:{_CAPITAL}(?:\. ?(?={_CAPITAL})| (?={_CAPITAL})))*"
_NAME = rf"{_INITIALS}(?:{_PART}(?:[ -]{_INITIALS}{_PART}){{0,2}}|{_CAPITAL}\.)"
_KEYWORD = (r"(?:token|passw(?:or)?d|passphrase|pwd|secret|credentials?"
            r"|(?:api|access|account|auth|client|encryption|master|private|shared|signing)[_-]?key)"
            r"(?:[_-]?(?:key|id|value|hash|token|secret|password|string|prod|dev|test|\d+))*")
# to white space, but not into a further assignment, a quote around the whole, or punctuation behind it
_BARE = r"""(?:(?![&;,]\s?[\w-]+=|["'](?:\W|$)|</)\S){6,}(?<![.,;:)\]}])"""
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
    "secret": rf"(?i:{_KEYWORD})" r"""\\?["']?\s{0,3}(?::=|=>|={1,3}|:)\s{0,3}"""
              r"""(?:"(?P<secret_double>(?:[^"\\\n]|\\.){6,})"|'(?P<secret_single>(?:[^'\\\n]|\\.){6,})'"""
              rf"""|["']?(?P<secret_value>{_BARE}))""",
    "key": r"\b(?:AKIA|ASIA)(?P<key_value>[A-Z0-9]{16})\b|\bgh[pousr]_(?P<hub_value>[A-Za-z0-9]{36})\b"
           r"|\bsk-(?:[a-z]{2,8}-){0,2}(?P<provider_value>[A-Za-z0-9]{20,})\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "card": r"(?<![\d+-])\d(?:[ -]?\d){12,18}(?![\d-]*\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w.+])(?:(?:\+|00(?=[1-9]))\d(?:[ ./()-]{0,2}\d){7,14}"  # with a country code, grouped in any way
             r"|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}"
             r"|0[1-9](?P<phone_by>[ .-]?)\d\d(?:(?P=phone_by)\d\d){3}|\d{3}(?P<phone_gap>[ .-])\d\d(?:(?P=phone_gap)\d\d){2})"
             r"(?!\w)",
    "name": rf"\b(?P<title>{_TITLE})\.? (?P<name_value>{_NAME})",
}
ENTITY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()))
#: A text without any of these holds no entity.
HINT = re.compile(rf"[\d@]|(?:{_TITLE})\.? |(?i:token|pass|pwd|secret|credential|key)|AKIA|ASIA|gh[pousr]_|sk-")
_WHOLE = {"secret": ("secret_double", "secret_single", "secret_value"), "key": ("key_value", "hub_value", "provider_value"), "name": ("name_value",)}

ROUNDS = 8
#: Characters exchanged as one number; longer values are several.
BLOCK = 256


def _walk(key: bytes, domain: str, number: int, size: int, turns) -> int:
    """Feistel rounds, walked until they land in ``range(size)``; backwards if ``turns`` are."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, wide = (1 << half) - 1, (half + 7) // 8
    head = f"{domain}|".encode("utf-8", "surrogatepass")
    forth = turns[0] == 0
    while True:
        left, right = number >> half, number & mask
        for turn in turns:
            seen = right if forth else left
            message = b"%b%d|%b" % (head, turn, seen.to_bytes(wide, "big"))
            block = hmac.digest(key, message, hashlib.sha256)
            while len(block) < wide:
                block += hmac.digest(key, block, hashlib.sha256)
            mixed = int.from_bytes(block[:wide], "big") & mask
            left, right = (right, left ^ mixed) if forth else (right ^ mixed, left)
        number = left << half | right
        if number < size:
            return number


def permute(key: bytes, domain: str, number: int, size: int) -> int:
    """The image of ``number`` under a keyed permutation of ``range(size)`` that is one cycle.

    Each number becomes its successor in a keyed order, so none is its own image.
    """
    if size <= 1:
        return number
    place = _walk(key, domain, number, size, range(ROUNDS))
    return _walk(key, domain, (place + 1) % size, size, range(ROUNDS - 1, -1, -1))


@lru_cache(1)
def _alphabet() -> dict[str, tuple[str, int]]:
    """Each exchangeable character with its class and its place there."""
    out = {}
    for letters in ("0123456789", *LETTERS, *(x.upper() for x in LETTERS)):
        for i, c in enumerate(letters):
            out[c] = (letters, i)
    return out


def _turns(c: str) -> bool:
    """Whether a letter's other case is one letter that leads back."""
    other = c.swapcase()
    return other != c and len(other) == 1 and other.swapcase() == c


def _low(text: str) -> str:
    """Lower case of the same length from which the case can be given back."""
    return text.lower() if text.isascii() else "".join(c.lower() if c.isupper() and _turns(c) else c for c in text)


def _cased(text: str, like: str) -> str:
    return "".join(c.upper() if o.isupper() and _turns(o) else c for c, o in zip(text, like))


@lru_cache(1 << 12)
def _others(c: str) -> str:
    """Letters and digits of the kind of ``c`` in its row of the code table, where ``LETTERS`` has none."""
    row = (chr(i) for i in range(ord(c) & ~255, (ord(c) | 255) + 1))
    return "".join(x for x in row if x.isalnum() and x not in _alphabet() and _turns(x) == _turns(c)
                   and unicodedata.category(x) == unicodedata.category(c))


def _place(c: str) -> tuple[str, int] | None:
    """The class of an exchangeable character and its place there."""
    found = _alphabet().get(c)
    if found is None and c.isalnum():
        letters = _others(c)
        found = (letters, letters.index(c)) if len(letters) > 1 else None
    return found


def _exchange(key: bytes, kind: str, text: str, fixed: int = 0, classes=None) -> str:
    """Replace every letter and digit of ``text`` but the first ``fixed`` within its class, as one number."""
    pick = classes or _place
    form, slots = [], []
    for i, c in enumerate(text):
        found = pick(c) if i >= fixed else None
        if found is None:
            form.append(c)
        else:
            form.append(f"\x00{found[0][0]}{len(found[0])}")
            slots.append((i, *found))
    domain, out = kind + "".join(form), list(text)
    if len(slots) > BLOCK:
        domain = hashlib.sha256(domain.encode("utf-8", "surrogatepass")).hexdigest()
    for at in range(0, len(slots), BLOCK):  # one number each; what came before says which permutation
        number, size, some = 0, 1, slots[at:at + BLOCK]
        for _, letters, place in some:
            number, size = number * len(letters) + place, size * len(letters)
        image = permute(key, domain, number, size)
        for i, letters, _ in reversed(some):
            image, place = divmod(image, len(letters))
            out[i] = letters[place]
        if at + BLOCK < len(slots):
            whole = number.to_bytes((size.bit_length() + 7) // 8, "big")
            domain = hashlib.sha256(domain.encode() + whole).hexdigest()
    return "".join(out)


def _fill(shape: str, digits: str) -> str:
    """``digits`` in place of the digits of ``shape``, in its script."""
    rest = iter(digits)
    return "".join(chr(ord(c) - unicodedata.decimal(c) + int(next(rest))) if c.isdecimal() else c for c in shape)


def _check_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _digits(value: str) -> str:
    return "".join(str(unicodedata.decimal(c)) for c in value if c.isdecimal())


def _card(key: bytes, value: str) -> str:
    digits = _digits(value)
    if _check_digit(digits[:-1]) == digits[-1]:
        body = _exchange(key, "card", digits[:-1], 1)
        return _fill(value, body + _check_digit(body))
    image = _exchange(key, "other card", digits, 1)
    while _check_digit(image[:-1]) == image[-1]:  # stays among the numbers without a valid check digit
        image = _exchange(key, "other card", image, 1)
    return _fill(value, image)


def _reach(octets: list[int]) -> str:
    a, b = octets[:2]
    if a == 10 or (a, b) == (192, 168) or a == 172 and 16 <= b < 32:
        return "private"
    return "special" if a in (0, 127) or a >= 224 or (a, b) == (169, 254) else "public"


def _ip(key: bytes, value: str) -> str:
    octets = [int(x) for x in value.split(".")]
    reach = _reach(octets)
    number = int.from_bytes(bytes(octets), "big")
    while True:
        number = permute(key, f"ip {reach}", number, 1 << 32)
        image = list(number.to_bytes(4, "big"))
        if _reach(image) == reach:
            return ".".join(map(str, image))


_COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")


def _phone(key: bytes, value: str) -> str:
    """Country code and the digit behind it kept, however the number is grouped."""
    digits = _digits(value)
    abroad = 0 if value[0] == "+" else 2 if digits.startswith("00") else None
    code = _COUNTRY.match(digits, abroad).group() if abroad is not None else ""
    head = (abroad or 0) + len(code)
    rest = _exchange(key, f"phone +{code}" if code else "phone ", digits[head + 1:])
    return _fill(value, digits[:head + 1] + rest)


def _email(key: bytes, value: str) -> str:
    local, _, domain = _low(value).rpartition("@")
    *labels, top = domain.split(".")
    new = ".".join([_exchange(key, "domain", ".".join(labels)), top])
    return _cased(_exchange(key, f"mail of {domain}", local) + "@" + new, value)


_PLAIN = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _letters(value: str) -> str:
    """What the digits and plain letters of a secret are taken from."""
    upper = value.upper() == value
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        return "0123456789ABCDEF" if upper else "0123456789abcdef"
    return _PLAIN[:36] if upper else _PLAIN


def _secret(key: bytes, value: str) -> str:
    letters, image = _letters(value), value
    kind = "hex" if len(letters) == 16 else "secret"
    while True:  # stays among the secrets of its alphabet
        image = _exchange(key, kind, image, 0,
                          lambda c: (letters, letters.index(c)) if c in letters else None if c.isascii() else _place(c))
        if _letters(image) == letters:
            return image


def _name(key: bytes, value: str) -> str:
    """Each part of a name by itself, so that the same surname or given name stays the same."""
    def part(m: re.Match) -> str:
        word = m.group()
        for (script, sex), names in GIVEN.items():
            if word in names:
                return names[permute(key, f"given {script} {sex}", names.index(word), len(names))]
        image, keep = word, min(1, len(word) - 1)  # of an initial nothing stays
        while True:  # never one of the listed given names, which have surrogates of their own
            end = word[len(word) - keep:]
            image = _cased(_exchange(key, f"name {end}", _low(image[:len(word) - keep])) + end, word)
            if not any(image in names for names in GIVEN.values()):
                return image

    return re.sub(_WORD, part, value)


def _iban(key: bytes, value: str) -> str:
    """Country kept, the rest exchanged, check digits made to fit."""
    plain = value.replace(" ", "")
    body = _exchange(key, f"iban {plain[:2]}", plain[4:])
    as_number = "".join(str(int(c, 36)) for c in body + plain[:2] + "00")
    valid = int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    check = f"{98 - int(as_number) % 97:02d}" if valid else plain[2:4]
    rest = iter(plain[:2] + check + body)
    return "".join(c if c == " " else next(rest) for c in value)


MAKERS = {
    "email": _email, "secret": _secret, "key": _secret, "iban": _iban, "ip": _ip, "card": _card,
    "ssn": lambda key, value: _fill(value, _exchange(key, "ssn", _digits(value))),
    "phone": _phone, "name": _name,
}
_CANONICAL = {"email": _low, "card": _digits, "ssn": _digits, "iban": lambda v: v.replace(" ", ""),
              "phone": lambda v: "+" + _digits(v) if v[0] == "+" else re.sub("^00", "+", _digits(v))}


def _movable(kind: str, value: str) -> bool:
    """Whether anything can be exchanged: a row of dots or stars is no entity."""
    return any(_place(c) for c in (value.rpartition(".")[0] if kind == "email" else value))


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, value) of every entity, in order and without overlap."""
    if not text or not HINT.search(text):
        return []
    out = []
    for m in ENTITY.finditer(text):
        kind = next(k for k in PATTERNS if m.group(k) is not None)
        group = next((g for g in _WHOLE.get(kind, ()) if m.group(g) is not None), kind)
        if _movable(kind, m.group(group)):
            out.append((m.start(group), m.end(group), kind, m.group(group)))
    return out


def canonical(kind: str, value: str) -> str:
    """What two spellings of one entity have in common."""
    return _CANONICAL.get(kind, str)(value)


def surrogate(key: bytes, kind: str, value: str) -> str:
    return MAKERS[kind](key, value)


def rewrite(key: bytes, text: str | None) -> tuple[str | None, list[tuple[str, int]]]:
    """The text with surrogates, and (kind, begin in the new text) of each."""
    found = find(text) if text else []
    if not found:
        return text, []
    parts, at, size, marks = [], 0, 0, []
    for begin, end, kind, value in found:
        new = surrogate(key, kind, value)
        parts += (text[at:begin], new)
        size += begin - at
        marks.append((kind, size))
        size += len(new)
        at = end
    return "".join([*parts, text[at:]]), marks


def entities(docs: DataFrame, key: bytes) -> DataFrame:
    """Every distinct entity with its surrogate and the documents' mentions of it."""
    def mentions(batches):
        for batch, texts in slices(batches):
            counts: dict[tuple[str, str], int] = {}
            for text in texts:
                for _, _, kind, value in find(text) if text else ():
                    one = (kind, canonical(kind, value))
                    counts[one] = counts.get(one, 0) + 1
            rows = [(k, v, canonical(k, surrogate(key, k, v)), n) for (k, v), n in counts.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                                 ["kind", "value", "surrogate", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(
        mentions, "kind string, value string, surrogate string, n long") \
        .groupBy("kind", "value", "surrogate").agg(F.sum("n").alias("mentions"))


def collisions(found: DataFrame) -> DataFrame:
    """Surrogates that stand for several values, values with several surrogates, and values that are their own."""
    by = lambda one, other: found.groupBy("kind", one).agg(
        F.count_distinct(other).alias("n")).filter("n > 1").select("kind", F.col(one).alias("what"), "n")
    same = found.filter("value = surrogate").select("kind", F.col("value").alias("what"), F.lit(1).cast("long").alias("n"))
    return by("surrogate", "value").unionByName(by("value", "surrogate")).unionByName(same)


def check_distinct(docs: DataFrame, key: bytes) -> None:
    """Raise if surrogates of these documents lose distinctness or coreference, or equal their values."""
    bad = collisions(session.materialise(entities(docs, key))).count()
    if bad:
        raise ValueError(f"{bad} surrogates are not one to one or equal their values")


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with surrogates in ``text``, other columns as they are; ``n_chars`` follows where it is a column."""
    names = docs.columns

    def one(batches):
        for batch, texts in slices(batches):
            new = [rewrite(key, t)[0] for t in texts]
            columns = list(batch.columns)
            at = batch.schema.get_field_index("text")
            columns[at] = pa.array(new, columns[at].type)
            if "n_chars" in names:
                at = batch.schema.get_field_index("n_chars")
                old = columns[at].to_pylist()
                columns[at] = pa.array([n if a == b else len(b) for n, a, b in zip(old, texts, new)],
                                       columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(one, docs.schema)


def replaced(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id``, the new ``text``, ``n_entities`` and the entities' kinds and places."""
    def one(batches):
        for batch, texts in slices(batches):
            done = [rewrite(key, t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([t for t, _ in done], pa.string()),
                pa.array([len(m) for _, m in done], pa.int64()),
                pa.array([[{"kind": k, "at": a} for k, a in m] for _, m in done],
                         pa.list_(pa.struct([("kind", pa.string()), ("at", pa.int64())]))),
            ], ["doc_id", "text", "n_entities", "entities"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(one, "doc_id long, text string, n_entities long, "
                                  "entities array<struct<kind:string,at:long>>")
