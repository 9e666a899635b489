r"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets.

Method: a value that passes its validation is permuted within its format by a keyed, alternating Feistel network over
mixed radices (a digit stays a digit, a letter a letter of its case, punctuation stays). Where a format has further
rules, the network walks its cycle until the rules hold again: a permutation of exactly the values that pass. So equal
values have equal pseudonyms in all documents, different values have different ones, and who holds the key can go back.

Validated: payment cards (13 to 19 digits with a Luhn check digit, first digits and length of a network; the first digit stays and the check digit is made
anew), IBANs (mod 97, made anew; country stays), US social security numbers, telephone numbers (8 to 15 digits with a
plus, or the North American form; the country code stays), calendar dates (ISO, and day-month-year or month-day-year;
the century stays), IPv4 addresses (private, loopback, multicast and other stay what they are), the local part of mail
addresses (case apart), access keys and values assigned to password, token, secret or key. What follows a card or
an IBAN after a blank or hyphen may look like more of it: where the longest match is not valid, shorter ones that end
with a group are tried. A telephone number with a plus ends with the group that gives its country's fixed length, if there
is one, else with the last one that leaves a valid length; the North American form has one pseudonym with and without +1.

Key: the setting spark.millrace.pseudonyms.key, else one drawn at random for the application; none is published. Values of
more than AT_ONCE letters and digits are permuted in parts, each keyed by those before it, forth and back.

Defined cases: null text stays null, with no finds; empty text stays empty; overlapping finds go to the one that begins
first, then to the order above; repeated rows give repeated rows; an empty table gives no rows; other columns stay
inside the struct `row`, whatever their names; texts are read whole.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache
from ipaddress import IPv4Address

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("mail", "secret", "iban", "date", "ipv4", "card", "ssn", "phone")
ROUNDS = 10
#: Letters and digits that the network takes at once; longer values are chained.
AT_ONCE = 64
#: The setting that holds the key.
KEY_SETTING = "spark.millrace.pseudonyms.key"

LOWER_CASE = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"

PATTERNS = {
    "mail": r"(?<![\w.+-])(?P<local>[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?)@(?=(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}\b)",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA(?P<access>[0-9A-Z]{16})(?![0-9A-Za-z])|gh[pousr]_(?P<hub>[A-Za-z0-9]{36,})|(?i:pass(?:word|wd)|pwd|secret|token|api[_-]?key|access[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?(?P<value>[^\s\"',;]{6,}))",
    "iban": r"(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "date": r"(?<![\d./-])(?:(?P<iso>\d{4}-\d{2}-\d{2})|(?P<dmy>\d{1,2}(?P<sep>[./-])\d{1,2}(?P=sep)\d{4}))(?![\d/-])",
    "ipv4": r"(?<![\d.])(?P<ipv4>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\.?\d)",
    "card": r"(?<![\d.+-])(?P<card>\d(?:[ -]?\d){12,18})(?!\d)",
    "ssn": r"(?<![\d-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])",
    "phone": r"(?<![\d+])(?:\+(?P<tail>\d{1,3}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,4})){2,6})|(?P<nanp>(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}))(?!\d)",
}
#: The groups that hold a kind's value, where it isn't one of its own name.
GROUPS = {"mail": ("local",), "secret": ("access", "hub", "value"), "date": ("iso", "dmy"), "phone": ("tail", "nanp")}
#: What may stand between a value's groups and before another word.
SEPARATORS = {"iban": " ", "card": " -", "phone": " .-("}
#: Country codes of one and of two digits; all others have three.
SHORT_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Digits after the country code, where a country's numbers all have as many.
NATIONAL = {"1": 10, "7": 10, "27": 9, "30": 10, "31": 9, "33": 9, "34": 9, "41": 9, "45": 8, "48": 9, "52": 10, "61": 9, "90": 10, "91": 10, "351": 9, "420": 9, "421": 9, "380": 9}
#: The first digits of the card networks' numbers, from and to, and how long these are.
NETWORKS = (
    ("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)), ("300", "305", range(14, 20)), ("36", "36", range(14, 20)),
    ("38", "39", range(14, 20)), ("3528", "3589", range(16, 20)), ("50", "50", range(13, 20)), ("56", "58", range(13, 20)), ("60", "60", range(16, 20)), ("62", "62", range(16, 20)),
    ("644", "649", range(16, 20)), ("65", "65", range(16, 20)), ("67", "67", range(13, 20)),
)
FIND = re.compile("|".join(f"(?P<{k}_>{PATTERNS[k]})" for k in KINDS))
#: No find is without a digit, an at sign or one of these.
HINT = re.compile(r"[0-9@]|(?i:pass|pwd|secret|token|key)|gh[pousr]_")


def hex_digits(text: str) -> str | None:
    """The hexadecimal digits of the text's case, if it is a hexadecimal number with letters and digits."""
    for letters in ("abcdef", "ABCDEF"):
        if re.fullmatch(rf"(?=.*\d)(?=.*[{letters}])[0-9{letters}]{{8,}}", text):
            return DIGITS + letters
    return None


class Feistel:
    """Keyed permutations of strings of digits in mixed radices."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _f(self, label: str, nth: int, half: int, modulus: int) -> int:
        size = (modulus.bit_length() + 7) // 8 + 8
        out, k = b"", 0
        text = f"{label}|{nth}|{half:x}|"
        while len(out) < size:
            out += hashlib.blake2b(f"{text}{k}".encode(), key=self.key, digest_size=64).digest()
            k += 1
        return int.from_bytes(out[:size], "big") % modulus

    def step(self, label: str, value: int, left: int, right: int, back: bool = False) -> int:
        """One permutation of range(left * right)."""
        a, b = divmod(value, right)
        sign = -1 if back else 1
        for n in reversed(range(self.rounds)) if back else range(self.rounds):
            if n % 2:
                b = (b + sign * self._f(label, n, a, right)) % right
            else:
                a = (a + sign * self._f(label, n, b, left)) % left
        return a * right + b

    def below(self, label: str, value: int, size: int, allowed: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """A permutation of the allowed values under size, by cycle walking."""
        left = 1
        while left * left < size:
            left += max(1, left // 64)
        right = -(-size // left)
        while True:
            value = self.step(f"{label}|{size}", value, left, right, back)
            if value < size and allowed(value):
                return value

    def text(self, label: str, text: str, allowed: Callable[[str], bool] = lambda _: True, back: bool = False) -> str:
        """Permutes the letters and digits of a text, each within its class; the rest stays."""
        hexed = hex_digits(text)
        sets = []
        for c in text:
            if hexed:
                sets.append(hexed)
            else:
                sets.append(next((s for s in (DIGITS, LOWER_CASE, LOWER_CASE.upper()) if c in s), None))
        at = [i for i, s in enumerate(sets) if s]
        if not at:
            return text
        out = list(text)
        while True:
            self._pass(label, out, sets, at, back)
            new = "".join(out)
            if hex_digits(new) == hexed and allowed(new):
                return new

    def _pass(self, label: str, out: list[str], sets: list[str | None], at: list[int], back: bool) -> None:
        """Permutes the places `at` of out: all together, or, where they are many, in parts that each depend on those
        before it, and once more in the opposite direction, so that every part depends on all of them."""
        parts = [at[k : k + AT_ONCE] for k in range(0, len(at), AT_ONCE)]
        if len(parts) == 1:
            self._part(f"{label}|{''.join('-' if s is None else str(len(s)) + s[0] for s in sets)}", out, sets, at, back)
            return
        for forth in (False, True) if back else (True, False):
            order = parts if forth else parts[::-1]
            told = hashlib.blake2b(f"{label}|{len(out)}|{forth}".encode(), digest_size=32)
            for part in order:
                tweak = told.hexdigest()
                before = "".join(out[i] for i in part)
                self._part(f"{label}|{tweak}|{','.join(str(len(sets[i])) + sets[i][0] for i in part)}", out, sets, part, back)
                # what a part was made of in one direction is known again in the other
                told.update((before if back else "".join(out[i] for i in part)).encode())

    def _part(self, label: str, out: list[str], sets: list[str | None], at: list[int], back: bool) -> None:
        half = len(at) // 2
        sizes = [1, 1]
        value = 0
        for k, i in enumerate(at):
            sizes[k >= half] *= len(sets[i])
            value = value * len(sets[i]) + sets[i].index(out[i])
        value = self.step(label, value, *sizes, back)
        for i in reversed(at):
            value, d = divmod(value, len(sets[i]))
            out[i] = sets[i][d]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def issued(digits: str) -> bool:
    """Whether a network issues card numbers that begin so and are as long."""
    return any(low <= digits[: len(low)] <= high and len(digits) in sizes for low, high, sizes in NETWORKS)


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def country_code(digits: str) -> str:
    """The country code that a telephone number with a plus begins with."""
    return next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3])


def _fill(form: str, digits: str) -> str:
    """The digits in the places that letters and digits have in the form."""
    it = iter(digits)
    return "".join(next(it) if c.isalnum() else c for c in form)


def _ip_class(n: int) -> int:
    ranges = ((10, 8), (127, 8), (0xAC10 >> 4, 12), (0xC0A8, 16), (0xE, 4), (0xF, 4))
    return next((k for k, (top, bits) in enumerate(ranges) if n >> (32 - bits) == top), -1)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.feistel = Feistel(key)
        self.value = lru_cache(maxsize=1 << 16)(self._value)

    def _value(self, kind: str, group: str, text: str) -> str | None:
        """The value's pseudonym, None if the value isn't valid."""
        return getattr(self, f"_{kind}")(group, text)

    def _mail(self, _: str, text: str) -> str:
        return self.feistel.text("mail", text.lower())

    def _secret(self, group: str, text: str) -> str:
        return self.feistel.text(f"secret {group}", text)

    def _card(self, _: str, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not luhn(digits) or not issued(digits):
            return None
        body = digits[0] + self.feistel.text("card", digits[1:-1] + "-", lambda x: issued(digits[0] + x))[:-1]
        return _fill(text, body + next(c for c in DIGITS if luhn(body + c)))

    def _iban(self, _: str, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or mod97(plain) != 1:
            return None
        body = self.feistel.text("iban " + plain[:2], plain[4:] + "-")[:-1]
        return _fill(text, plain[:2] + f"{98 - mod97(plain[:2] + '00' + body):02}" + body)

    def _ssn(self, _: str, text: str) -> str | None:
        fine = lambda x: x[:3] not in ("000", "666") and x[0] != "9" and x[4:6] != "00" and x[7:] != "0000"
        return self.feistel.text("ssn", text, fine) if fine(text) else None

    def _phone(self, group: str, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        code = country_code(digits) if group == "tail" else ""
        tail = digits[len(code) :]
        if group == "tail" and not (len(tail) >= 6 and 8 <= len(digits) <= 15):
            return None
        label = "nanp" if code == "1" and len(tail) == NATIONAL[code] else group
        return _fill(text, code + self.feistel.text(f"phone {label}", tail + "-")[:-1])

    def _ipv4(self, _: str, text: str) -> str | None:
        try:
            n = int(IPv4Address(text))
        except ValueError:
            return None
        kind = _ip_class(n)
        keep = 32 if kind < 0 else (24, 24, 20, 16, 28, 28)[kind]
        low = self.feistel.below(f"ipv4 {kind}", n & ((1 << keep) - 1), 1 << keep, (lambda x: _ip_class(x) < 0) if kind < 0 else lambda _: True)
        return str(IPv4Address((n >> keep << keep) + low))

    def _date(self, group: str, text: str) -> str | None:
        parts = [int(x) for x in re.split(r"[./-]", text)]
        orders = ((0, 1, 2),) if group == "iso" else ((2, 1, 0), (2, 0, 1))
        for order in orders:
            try:
                day = date(*(parts[i] for i in order))
            except ValueError:
                continue
            first = date(max(1, day.year // 100 * 100), 1, 1)
            last = date(day.year // 100 * 100 + 99, 12, 31)
            # month-day-year is only taken where day-month-year is no date, and stays so
            fits = (lambda n: date.fromordinal(n + first.toordinal()).day > 12) if order == (2, 0, 1) else lambda _: True
            to = date.fromordinal(first.toordinal() + self.feistel.below(f"date {order}", day.toordinal() - first.toordinal(), last.toordinal() - first.toordinal() + 1, fits))
            if group == "iso":
                return to.isoformat()
            sep = re.search(r"[./-]", text)[0]
            a, b = (to.day, to.month) if order == (2, 1, 0) else (to.month, to.day)
            wide = len(text) == 10
            return f"{a:02}{sep}{b:02}{sep}{to.year:04}" if wide else f"{a}{sep}{b}{sep}{to.year:04}"
        return None

    def replace(self, text: str) -> tuple[str, list[int]]:
        """The text with pseudonyms, and the finds of each kind."""
        counts = [0] * len(KINDS)
        if not HINT.search(text):
            return text, counts
        out, done, at = [], 0, 0
        while m := FIND.search(text, at):
            kind = next(k for k in KINDS if m[f"{k}_"] is not None)
            new, span = self._tried(text, kind, m)
            if new is None:
                # not valid as this kind: another kind may begin here or within
                new, kind, span = self._other(text, m)
                if new is None:
                    at = m.start() + 1
                    continue
            counts[KINDS.index(kind)] += 1
            out += [text[done : span[0]], new]
            done = span[1]
            at = max(done, m.start() + 1)
        return "".join([*out, text[done:]]), counts

    def _tried(self, text: str, kind: str, m: re.Match) -> tuple[str | None, tuple[int, int]]:
        """The pseudonym of the longest valid match that begins where m does, and its place."""
        for n in _ends(text, kind, m):
            group = next(g for g in GROUPS.get(kind, (kind,)) if n[g] is not None)
            new = self.value(kind, group, n[group])
            if new is not None:
                return new, n.span(group)
        return None, (0, 0)

    def _other(self, text: str, m: re.Match) -> tuple[str | None, str, tuple[int, int]]:
        for kind in KINDS[KINDS.index(next(k for k in KINDS if m[f"{k}_"] is not None)) + 1 :]:
            if n := _ALONE[kind].match(text, m.start()):
                new, span = self._tried(text, kind, n)
                if new is not None:
                    return new, kind, span
        return None, "", (0, 0)


def _ends(text: str, kind: str, m: re.Match) -> list[re.Match]:
    """The match and, for kinds that the next word may look like a part of, shorter ones that end with a group."""
    found = [m]
    if kind in SEPARATORS:
        for end in range(m.end() - 1, m.start(), -1):
            if text[end] in SEPARATORS[kind] and (n := _ALONE[kind].match(text, m.start(), end)) and n.end() == end:
                found.append(n)
    if kind == "phone" and len(found) > 1 and m["tail"]:
        digits = [re.sub(r"\D", "", n["tail"]) for n in found]
        code = country_code(digits[0])
        # a number of the country's length goes first
        found = [found[k] for k in sorted(range(len(found)), key=lambda k: len(digits[k]) - len(code) != NATIONAL.get(code))]
    return found


_ALONE = {k: re.compile(v) for k, v in PATTERNS.items()}


def key_of(spark: SparkSession) -> bytes:
    """The key of the setting; where it is not set, one drawn at random for this application: values are then linked
    within it alone, and nobody can go back."""
    given = spark.conf.get(KEY_SETTING, None)
    if given:
        return given.encode()
    sc = spark.sparkContext
    if not hasattr(sc, "_millrace_key"):
        sc._millrace_key = secrets.token_bytes(32)
    return sc._millrace_key


def pseudonymised(docs: DataFrame, key: bytes | None = None, text_col: str = "text") -> DataFrame:
    """docs as struct `row`, with clean, the text with pseudonyms, and finds, their number by kind."""
    at = docs.columns.index(text_col)
    key = key_of(docs.sparkSession) if key is None else key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Pseudonyms(key)
        for batch in batches:
            out = [(None, [0] * len(KINDS)) if t is None else made.replace(t) for t in batch.column(0).field(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in out], pa.string()), pa.array([c for _, c in out], pa.list_(pa.int64()))], names=["row", "clean", "finds"])

    return docs.select(F.struct("*").alias("row")).mapInArrow(run, f"row {docs.schema.simpleString()}, clean string, finds array<long>")


def pseudonym_report(docs: DataFrame, key: bytes | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text with pseudonyms, number of finds by kind) of every row."""
    out = pseudonymised(docs.select(id_col, text_col), key, text_col)
    counts = [F.col("finds")[k].alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return out.select(F.col("row").getField(id_col).alias(id_col), F.col("clean").alias("text"), *counts)


def with_pseudonyms(docs: DataFrame, key: bytes | None = None, text_col: str = "text") -> DataFrame:
    """docs, their texts with pseudonyms."""
    out = pseudonymised(docs, key, text_col)
    return out.select(*(F.col("clean").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
