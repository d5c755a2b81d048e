"""PII (operator 7): format-preserving Feistel pseudonyms.

Found and validated values are replaced by a keyed permutation of all values of their format, so equal values stay equal
across documents, different values stay different, and the pseudonym passes the same validation:

* card: 13-19 digits with a valid Luhn digit; the payload is permuted and the check digit computed anew;
* iban: two letters, check digits and account of a valid mod-97 number; letters and digits of the account are permuted
  within their kind and the check digits computed anew;
* phone: an optional country code and ten digits ``(ddd) ddd-dddd`` or ``ddd-ddd-dddd``; the ten digits are permuted;
* ssn: ``ddd-dd-dddd`` in the issued ranges, permuted among such numbers;
* ip: four octets, permuted as a 32-bit number;
* date: ``yyyy-mm-dd``, ``dd/mm/yyyy`` or ``dd.mm.yyyy`` that exists in the calendar, permuted among the days of its century;
* email: letters and digits of the local part (its last 64 characters) are permuted within their kind, the domain stays;
* secret: hexadecimal values with a digit assigned to a token, password, secret or key, and 20-character access ids with a
  digit, permuted within their alphabet.

The key is the caller's; there is no default.  ``session_key`` reads it from the session, or draws a random one for the
session, with which values are linked within that session only.  Whoever holds the key can invert the pseudonyms.

A text is scanned once, in time proportional to its length, however long its unbroken runs are: addresses are looked for
from their at sign.

Digits, separators, case and padding stay where they were; text outside the found values is never changed.

A value need not stand alone.  Of digits joined by single spaces or hyphens every sub-run of whole groups that is a valid
card counts; of overlapping ones the one grouped like a card, then like an issued number, then the longest, then the first
is taken.  Of an IBAN joined to more words the longest valid run of whole words is taken.  A value that fails its
validation hides no other: the other kinds are tried at its place, and the scan goes on inside it.

Defined results: a null text stays null with no findings; every input row gives one row with all its columns; repeated
rows give repeated rows.  Only the column named ``text`` is read and replaced; a clashing column of another name is
carried along untouched.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import math
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ["email", "iban", "ip", "phone", "ssn", "date", "card", "secret"]
ROUNDS = 8
SPELL = 256  # characters permuted as one number
LOCAL = 64  # longest local part of an address
KEY_CONF = "spark.traitlens.pii.secret"  # "secret": Spark redacts the value in its logs

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
_HEX = "0123456789abcdef"
_ACCENTED = "".join(chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha())

PATTERN = re.compile(
    r"""
    (?P<secret>(?:(?<=token)|(?<=password)|(?<=secret)|(?<=key)|(?<=TOKEN)|(?<=PASSWORD)|(?<=SECRET)|(?<=KEY))
      \s{0,3}[=:]\s{0,3}["']?(?:[0-9a-f]{12,}|[0-9A-F]{12,})(?![0-9A-Za-z]) | (?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z]))
  | (?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}(?![0-9A-Za-z]))
  | (?P<ip>(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9]))
  | (?P<date>(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?!(?![Tt](?![A-Za-z]))[0-9A-Za-z]|[./-][0-9]))
  | (?P<ssn>(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9]))
  | (?P<phone>(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9]))
  | (?P<card>(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]))
    """,
    re.VERBOSE,
)
# The kinds that may follow, at the same place, a match of the kind that fails its validation.
_INSTEAD = {
    kind: re.compile("|".join(PATTERN.pattern.split("\n  | ")[i + 1 :]), re.VERBOSE)
    for i, kind in enumerate(["secret", "iban", "ip", "date", "ssn", "phone"])
}
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_NOT_LOCAL = re.compile(r"[\s@<>\"'(),:;=\[\]{}|]")
_DIGIT_RUN = re.compile("[0-9](?:[ -]?[0-9])*")
_DIGIT_GROUP = re.compile("[0-9]+")
_CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)} | {(n,) for n in range(13, 20)}


class Permutation:
    """Keyed Feistel permutations of the integers below any bound, by unbalanced rounds and cycle walking."""

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode()).digest()

    def _round(self, label: str, i: int, n: int, value: int) -> int:
        data = f"{label}|{n}|{i}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def __call__(self, label: str, value: int, n: int) -> int:
        """Image of ``value`` in ``0..n-1``; ``label`` selects the permutation."""
        if n < 2:
            return value
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(value, b)
            for i in range(0, ROUNDS, 2):
                left = (left + self._round(label, i, n, right)) % a
                right = (right + self._round(label, i + 1, n, left)) % b
            value = left * b + right
            if value < n:
                return value

    def among(self, label: str, value: int, n: int, valid: Callable[[int], bool]) -> int:
        """Image of a valid value among the valid values below ``n``."""
        while True:
            value = self(label, value, n)
            if valid(value):
                return value

    def spell(self, label: str, text: str, alphabets: list[str]) -> str:
        """Permute the characters of each alphabet as one number of as many digits (``SPELL`` at a time); others stay."""
        out = list(text)
        for alphabet in alphabets:
            places = [i for i, c in enumerate(text) if c in alphabet]
            for low in range(0, len(places), SPELL):
                at = places[low : low + SPELL]
                size, value = len(alphabet), 0
                for i in at:
                    value = value * size + alphabet.index(text[i])
                value = self(f"{label}|{alphabet}" + (f"|{low}" if low else ""), value, size ** len(at))
                for i in reversed(at):
                    value, c = divmod(value, size)
                    out[i] = alphabet[c]
        return "".join(out)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_value(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4]))


def _put_back(shape: str, characters: str) -> str:
    """``characters`` at the alphanumeric places of ``shape``."""
    it = iter(characters)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def card_runs(text: str, at: int) -> tuple[int, dict[int, int]]:
    """End of the run of joined digit groups at ``at``, and the valid cards in it that do not overlap, as start to end."""
    end = _DIGIT_RUN.match(text, at).end()
    groups = [g.span() for g in _DIGIT_GROUP.finditer(text, at, end)]
    if text[end : end + 1].isascii() and text[end : end + 1].isalnum():
        groups.pop()  # its last digits belong to a word
    ranked = []
    for i, (start, _) in enumerate(groups):
        digits, sizes = "", []
        for low, high in groups[i:]:
            if len(digits) + high - low > 19:
                break
            digits += text[low:high]
            sizes.append(high - low)
            if len(digits) >= 13 and luhn_digit(digits[:-1]) == digits[-1]:
                ranked.append((tuple(sizes) not in _CARD_GROUPS, digits[0] not in "23456", -len(digits), start, high))
    cards: dict[int, int] = {}
    taken: set[int] = set()
    for *_, start, high in sorted(ranked):
        if taken.isdisjoint(range(start, high)):
            taken.update(range(start, high))
            cards[start] = high
    return end, cards


def _card(p: Permutation, text: str) -> str | None:
    digits = re.sub(r"[ -]", "", text)
    if luhn_digit(digits[:-1]) != digits[-1]:
        return None
    payload = p.spell("card", digits[:-1], [_DIGITS])
    return _put_back(text, payload + luhn_digit(payload))


def _iban(p: Permutation, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_value(plain) % 97 != 1:
        return None
    account = p.spell("iban", plain[4:], [_DIGITS, _LOWER.upper()])
    check = 98 - _iban_value(plain[:2] + "00" + account) % 97
    return _put_back(text, f"{plain[:2]}{check:02d}{account}")


def _phone(p: Permutation, text: str) -> str | None:
    at = [i for i, c in enumerate(text) if c.isdigit()][-10:]
    spelled = p.spell("phone", "".join(text[i] for i in at), [_DIGITS])
    out = list(text)
    for i, c in zip(at, spelled):
        out[i] = c
    return "".join(out)


def _ssn_ok(v: int) -> bool:
    area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(p: Permutation, text: str) -> str | None:
    value = int(text.replace("-", ""))
    if not _ssn_ok(value):
        return None
    return _put_back(text, f"{p.among('ssn', value, 10**9, _ssn_ok):09d}")


def _ip(p: Permutation, text: str) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255:
        return None
    value = p("ip", int.from_bytes(bytes(octets), "big"), 1 << 32)
    return ".".join(str(x) for x in value.to_bytes(4, "big"))


def _date(p: Permutation, text: str) -> str | None:
    mark = next(c for c in text if not c.isdigit())
    parts = [int(x) for x in text.split(mark)]
    year, month, day = parts if mark == "-" else parts[::-1]
    try:
        value = datetime.date(year, month, day)
    except ValueError:
        return None
    low = datetime.date(max(1, year // 100 * 100), 1, 1).toordinal()
    days = datetime.date(year // 100 * 100 + 99, 12, 31).toordinal() - low + 1
    new = datetime.date.fromordinal(low + p("date", value.toordinal() - low, days))
    if mark == "-":
        return f"{new.year:04d}-{new.month:02d}-{new.day:02d}"
    width = 2 if any(len(x) == 2 and x[0] == "0" for x in text.split(mark)[:2]) or len(text) == 10 else 1
    return mark.join([f"{new.day:0{width}d}", f"{new.month:0{width}d}", f"{new.year:04d}"])


def _email(p: Permutation, text: str) -> str | None:
    local, _, domain = text.rpartition("@")
    spelled = p.spell(f"email|{domain.lower()}", local, [_LOWER, _LOWER.upper(), _DIGITS, _ACCENTED])
    if spelled == local:  # no character of the alphabets, or a fixed point of a short part
        spelled = _LOWER[p._round("email", 0, 26, 0) % 26] + spelled
    return f"{spelled}@{domain}"


def _secret(p: Permutation, text: str) -> str | None:
    if text.startswith("AKIA"):
        return "AKIA" + p.spell("access", text[4:], [_LOWER.upper() + _DIGITS])
    at = re.search(r"[0-9A-Fa-f]+$", text).start()
    value = text[at:]
    return text[:at] + p.spell("secret", value, [_HEX if value.lower() == value else _HEX.upper()])


_RULES = {"email": _email, "iban": _iban, "ip": _ip, "phone": _phone, "ssn": _ssn, "date": _date, "card": _card, "secret": _secret}


@functools.lru_cache(maxsize=1 << 16)
def _pseudonym(key: str, kind: str, text: str) -> str | None:
    return _RULES[kind](_permutation(key), text)


@functools.lru_cache(maxsize=4)
def _permutation(key: str) -> Permutation:
    return Permutation(key)


# A run of non-space characters holding a digit or an at sign: a value starts inside one, or just before it (an
# assignment's ``= "``, an opening bracket), so patterns are tried there only and not at every character of the text.
_NEAR = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
_BEFORE = 8


def addresses(text: str) -> Iterator[tuple[int, int, int]]:
    """First character, at sign and end of every e-mail address, in order."""
    sign = text.find("@")
    while sign >= 0:
        start = sign
        while start > max(0, sign - LOCAL) and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain is not None:
            yield start, sign, domain.end()
        sign = text.find("@", sign + 1)


_NONE = (-1, -1, -1)


def pseudonymise(text: str, key: str) -> tuple[str, dict[str, int]]:
    """The text with every validated value replaced, and how many of each kind."""
    counts: dict[str, int] = {}
    parts: list[str] = []
    done = at = run_end = 0
    cards: dict[int, int] = {}
    emails = addresses(text)
    email = next(emails, _NONE)
    for near in _NEAR.finditer(text):
        at = max(at, near.start() - _BEFORE)
        while at < near.end():
            while email is not _NONE and email[1] <= at:
                email = next(emails, _NONE)
            if email[0] <= at < email[1]:
                counts["email"] = counts.get("email", 0) + 1
                parts += [text[done:at], _pseudonym(key, "email", text[at : email[2]])]
                done = at = email[2]
                continue
            match = PATTERN.match(text, at)
            while match is not None:
                kind, end = match.lastgroup, match.end()
                if kind == "card":
                    if at >= run_end:
                        run_end, cards = card_runs(text, at)
                    end = cards.get(at, at)
                new = _pseudonym(key, kind, text[at:end]) if end > at else None
                while new is None and kind == "iban" and (end := text.rfind(" ", at, end)) > at:
                    new = _pseudonym(key, kind, text[at:end])
                if new is not None or kind == "card":
                    break
                match = _INSTEAD[kind].match(text, at)
            if match is None or new is None:
                at += 1
                continue
            counts[kind] = counts.get(kind, 0) + 1
            parts += [text[done:at], new]
            done = at = end
    if not parts:
        return text, counts
    return "".join([*parts, text[done:]]), counts


def _replacer(key: str, columns: list[str]):
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"]
            # Every value holds a digit or an at sign: texts without either are not scanned.
            some = pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False).to_pylist()
            found: list[dict[str, int]] = [{}] * len(batch)
            if any(some):
                values = texts.to_pylist()
                for i, scan in enumerate(some):
                    if scan:
                        values[i], found[i] = pseudonymise(values[i], key)
                texts = pa.array(values, texts.type)
            arrays = [texts if c == "text" else batch[c] for c in columns]
            arrays += [pa.array([f.get(k, 0) for f in found], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *(f"n_{k}" for k in KINDS)])

    return replace


def session_key(spark: SparkSession) -> str:
    """The session's key (``KEY_CONF``); where none is set, a random one that stays for the session."""
    key = spark.conf.get(KEY_CONF, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_CONF, key)
    return key


def with_pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` pseudonymised and one count column ``n_<kind>`` per kind (columns so named are replaced)."""
    extra = [f"n_{k}" for k in KINDS]
    source = docs.drop(*extra).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(list(source.schema.fields) + [T.StructField(c, T.LongType()) for c in extra])
    return source.mapInArrow(_replacer(key, source.columns), schema)
