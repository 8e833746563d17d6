"""Operator 9, PII: format-preserving Feistel pseudonyms.

Personal data are found by pattern and validated (check digits, calendar, address ranges), read as
a number of their format's own domain, and permuted there by a keyed Feistel network; numbers that
leave the domain walk on until they are back in it. So a pseudonym has the format and the validity
of the value, equal values get equal pseudonyms in every document, and the holder of the key can
restore them. No table of values is kept and nothing is shuffled.

Kinds: e-mail addresses (letters and digits of every part but the top-level domain), IPv4
addresses, calendar dates, telephone numbers (all but the country code), US social security
numbers, IBANs (check digits follow), card and other numbers of 13 to 19 digits (the check digit
follows where the number has a valid one) and hexadecimal secrets of 32 or more digits.

Values may stand beside each other and beside other digits. A group of 13 to 19 digits is a number
by itself; of smaller groups those that cards are written in, then the longest sum of groups with a
valid check digit, then what is left if it has 13 to 19 digits. More than 19 digits of small groups
without a valid sum stay. An IBAN has its country's length, or else the longest with valid check
digits. A pseudonym that would give its neighbourhood another reading is walked on; only there can
equal values have different pseudonyms.

Defined results: a NULL text stays NULL; a text without personal data is unchanged; rows are
treated one by one, so repeated rows and equal or NULL ids do no harm; an empty table gives an
empty table; all columns of the input are kept, and the columns that a function adds must not
exist already.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm.common import documents, query, small_batches

#: Key of the permutations for tests and examples. It is public: a deployment names its own secret in KEY_SETTING.
DEFAULT_KEY = b"tokenloom-example-key"
KEY_SETTING = "spark.tokenloom.pii.key"
ROUNDS = 10

FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1


class Feistel:
    """A keyed permutation of the numbers below ``size``, a separate one for every ``tweak``."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = key, rounds

    def _mix(self, tweak: bytes, turn: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        text = self.key + b"\0" + tweak + b"\0" + bytes((turn,)) + half.to_bytes(size, "little")
        return int.from_bytes(hashlib.shake_256(text).digest(size), "little") & ((1 << bits) - 1)

    def _once(self, value: int, bits: int, tweak: bytes, back: bool) -> int:
        left, right = value >> bits, value & ((1 << bits) - 1)
        for turn in reversed(range(self.rounds)) if back else range(self.rounds):
            if back:
                left, right = right ^ self._mix(tweak, turn, left, bits), left
            else:
                left, right = right, left ^ self._mix(tweak, turn, right, bits)
        return left << bits | right

    def permute(self, value: int, size: int, tweak: bytes, back: bool = False, valid: Callable[[int], bool] = lambda value: True) -> int:
        """The image of ``value`` among the valid numbers below ``size``; ``back`` undoes it."""
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            value = self._once(value, bits, tweak, back)
            if value < size and valid(value):
                return value


#: Longest value that is one number of a permutation; a longer one is permuted in pieces of about half that.
LONGEST = 512

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _alphabets(text: str) -> list[str]:
    return [DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else c for c in text]


def permute_characters(text: str, feistel: Feistel, tweak: bytes, back: bool, alphabets: list[str] | None = None) -> str:
    """Permute the characters, each within its own alphabet; a sign with an alphabet of one stays."""
    alphabets = alphabets or _alphabets(text)
    if len(text) > LONGEST:
        return _permute_long(text, feistel, tweak, back, alphabets)
    value, size = 0, 1
    for character, alphabet in zip(text, alphabets):
        value, size = value * len(alphabet) + alphabet.index(character), size * len(alphabet)
    if size == 1:
        return text
    # The shape of the text names the permutation.
    shape = tweak + b":" + "".join(alphabet[0] for alphabet in alphabets).encode()
    value = feistel.permute(value, size, shape, back)
    out = []
    for alphabet in reversed(alphabets):
        value, place = divmod(value, len(alphabet))
        out.append(alphabet[place])
    return "".join(reversed(out))


def _permute_long(text: str, feistel: Feistel, tweak: bytes, back: bool, alphabets: list[str]) -> str:
    """Pieces permuted from the first to the last and then from the last to the first.

    The digest of what is already permuted names a piece's permutation, so every piece of the result depends on the
    whole value, equal values stay equal, and the time grows with the length.
    """
    size = LONGEST // 2
    starts = list(range(0, max(1, len(text) - size // 2), size))
    pieces = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]
    kinds = [alphabets[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]
    for turn in (1, 0) if back else (0, 1):
        digest = hashlib.sha256(tweak + bytes((turn,)) + str(len(text)).encode())
        for i in reversed(range(len(pieces))) if turn else range(len(pieces)):
            permuted = permute_characters(pieces[i], feistel, tweak + digest.digest(), back, kinds[i])
            digest.update((pieces[i] if back else permuted).encode())
            pieces[i] = permuted
    return "".join(pieces)


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _digits_in_place(text: str, digits: str) -> str:
    found = iter(digits)
    return "".join(next(found) if c in DIGITS else c for c in text)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _email(text: str, feistel: Feistel, back: bool) -> str | None:
    head, dot, top = text.rpartition(".")
    return permute_characters(head, feistel, b"email", back) + dot + top


def _ip(text: str, feistel: Feistel, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = feistel.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, b"ip", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _day(year: str, month: str, day: str) -> int | None:
    try:
        number = datetime.date(int(year), int(month), int(day)).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return number if 0 <= number < DAYS else None


def _date(text: str, feistel: Feistel, back: bool) -> str | None:
    parts = re.split(r"[-/.]", text)
    signs = [c for c in text if c not in DIGITS]
    if signs[0] != signs[1]:
        return None
    widths = [len(p) for p in parts]
    date = lambda value: datetime.date.fromordinal(value + FIRST_DAY)
    # Written widths stay: one-digit days and months have a domain of their own.
    padded = all(width >= 2 for width in widths)
    fits = lambda n, width: n < 10 if width == 1 else padded or n >= 10
    if widths[0] == 4:
        order = ("year", "month", "day")
        number = _day(*parts)
    else:
        order = ("day", "month", "year")
        number = _day(parts[2], parts[1], parts[0])
        if number is None:
            order = ("month", "day", "year")
            number = _day(parts[2], parts[0], parts[1])
    if number is None:
        return None

    def valid(value: int) -> bool:
        found = date(value)
        if order[0] == "month" and found.day <= 12:
            return False  # it would be read with the day first
        return all(fits(getattr(found, name), width) for name, width in zip(order, widths) if name != "year")

    if not valid(number):
        return None
    tweak = b"date:" + ",".join([*order, *map(str, widths)]).encode()
    found = date(feistel.permute(number, DAYS, tweak, back, valid))
    return signs[0].join(str(getattr(found, name)).zfill(width) for name, width in zip(order, widths))


def _phone(text: str, feistel: Feistel, back: bool) -> str | None:
    head = re.match(r"\+\d{1,3}(?=\D)|", text).group()
    digits = _only_digits(text[len(head):])
    if not 7 <= len(digits) + len(_only_digits(head)) <= 15:
        return None
    return head + _digits_in_place(text[len(head):], permute_characters(digits, feistel, b"phone" + head.encode(), back))


def _ssn(text: str, feistel: Feistel, back: bool) -> str | None:
    def valid(value: int) -> bool:
        area, group, serial = value // 1_000_000, value // 10_000 % 100, value % 10_000
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    value = int(_only_digits(text))
    if not valid(value):
        return None
    return _digits_in_place(text, f"{feistel.permute(value, 10**9, b'ssn', back, valid):09d}")


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _iban(text: str, feistel: Feistel, back: bool) -> str | None:
    plain = text.replace(" ", "")
    country, rest = plain[:2], plain[4:]
    if _iban_check(country, rest) != plain[2:4]:
        return None
    rest = permute_characters(rest, feistel, b"iban" + country.encode(), back)
    found = iter(country + _iban_check(country, rest) + rest)
    return "".join(c if c == " " else next(found) for c in text)


def _number(text: str, feistel: Feistel, back: bool) -> str | None:
    digits = _only_digits(text)
    if luhn_digit(digits[:-1]) == digits[-1]:
        body = permute_characters(digits[:-1], feistel, b"card", back)
        return _digits_in_place(text, body + luhn_digit(body))
    # Without a valid check digit it must stay without one, or it would not come back.
    value = feistel.permute(
        int(digits), 10 ** len(digits), b"number%d" % len(digits), back,
        lambda v: (lambda d: luhn_digit(d[:-1]) != d[-1])(str(v).zfill(len(digits))),
    )
    return _digits_in_place(text, str(value).zfill(len(digits)))


def _secret(text: str, feistel: Feistel, back: bool) -> str | None:
    hexadecimal = DIGITS + ("ABCDEF" if any(c in UPPER for c in text) else "abcdef")
    if any(c not in hexadecimal for c in text) or text.isdigit():
        return None
    while True:
        text = permute_characters(text, feistel, b"secret" + hexadecimal[-1:].encode(), back, [hexadecimal] * len(text))
        if not text.isdigit() and (hexadecimal[-1] == "f" or any(c in UPPER for c in text)):
            return text


#: Kind, pattern and pseudonym; where patterns overlap, the first kind wins.
KINDS: tuple[tuple[str, str, Callable[[str, Feistel, bool], str | None]], ...] = (
    ("ip", r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)", _ip),
    ("date", r"(?<![\d./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d]|[./-]\d)", _date),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d]|-\d)", _ssn),
    ("secret", r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]{32})[0-9A-Fa-f]+(?![A-Za-z0-9])", _secret),
)
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
FOUND = [(kind, re.compile(pattern), pseudonym) for kind, pattern, pseudonym in KINDS]
#: Numbers are searched only where a digit stands.
CANDIDATE = re.compile(r"\d")

IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?= ?[A-Z0-9])")
IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){1,31}")
IBAN_SHAPE = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
#: Characters of an IBAN by country; other countries and lengths are told by their check digits alone.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
        26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR EG QA UA", 30: "JO KW MU PS", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}
#: Digit groups with single blanks or hyphens between them, of 13 digits or more.
RUN = re.compile(r"\d(?:[ -]?\d){12,}")
GROUP = re.compile(r"\d+")
#: Groups that cards are written in; they go before other sums of groups, so a year beside a card does not join it.
CARDS = ((4, 4, 4, 4), (4, 6, 5))
PHONE = re.compile(
    r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?(?:\d[ .-])?\d{2,4}(?:[ .-]?\d{2,4}){1,6}(?!\d)"
    r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?:(?<![\d-])|(?<=(?<![\d-])1-))\d{3}[.-]\d{3}[.-]\d{4}(?![\d]|-\d)"
)
#: No value is longer, with its separators.
REACH = 64


def _has_luhn(text: str) -> bool:
    digits = _only_digits(text)
    return luhn_digit(digits[:-1]) == digits[-1]


def _has_mod_97(text: str) -> bool:
    plain = text.replace(" ", "")
    return _iban_check(plain[:2], plain[4:]) == plain[2:4]


class Place(NamedTuple):
    """A value, or what would be one if it were valid; of those that overlap the least rank wins."""

    rank: tuple[int, ...]
    begin: int
    end: int
    valid: Callable[[str], bool] | None = None


PSEUDONYMS = {0: ("iban", _iban), 1: ("number", _number), 2: ("number", _number), 3: ("phone", _phone), 4: ("number", _number), 5: ("number", _number)}


def _blank(text: str, places: Iterable[tuple[int, int]]) -> str:
    """The text with a letter for every character of the places."""
    parts, last = [], 0
    for begin, end in sorted(places):
        parts += [text[last:begin], "x" * (end - begin)]
        last = end
    return "".join([*parts, text[last:]])


def _ibans(text: str) -> list[Place]:
    found = []
    for head in IBAN_HEAD.finditer(text):
        begin, rest = head.start(), IBAN_REST.match(text, head.end())
        for end in range(rest.end(), head.end(), -1):
            if text[end - 1] == " " or text[end : end + 1].isalnum() or not IBAN_SHAPE.fullmatch(text, begin, end):
                continue
            length = end - begin - text.count(" ", begin, end)
            found.append(Place((0, begin, int(IBAN_LENGTHS.get(head.group()[:2]) != length), -length), begin, end, _has_mod_97))
    return found


def _phones(text: str) -> list[Place]:
    """Telephone numbers: of the groups after a country code as many as a number of 15 digits can hold."""
    found, at = [], 0
    while match := PHONE.search(text, at):
        begin, end = match.span()
        while end > begin and len(_only_digits(text[begin:end])) > 15:
            # Back to the last border between groups.
            cut = re.search(r"[ .()-]+\d+$", text[begin:end])
            end = begin + cut.start() if cut else begin
        if end > begin and len(_only_digits(text[begin:end])) >= 7:
            found.append(Place((3, begin), begin, end))
        at = max(end, begin + 1)
    return found


def _groups(text: str) -> tuple[list[Place], list[list[tuple[int, int]]]]:
    """Groups of 13 to 19 digits, each a value by itself, and the sequences of other groups between them."""
    alone, stretches = [], []
    for run in RUN.finditer(text):
        plus = text[run.start() - 1 : run.start()] == "+"
        stretch: list[tuple[int, int]] = []
        first = 0
        for i, match in enumerate(GROUP.finditer(text, *run.span())):
            begin, end = match.span()
            if i == 0:
                first = end - begin
            phone = plus and (end - begin if i == 0 else first + end - begin if i == 1 and first <= 3 else 16) <= 15
            if 13 <= end - begin <= 19 and not phone:
                alone.append(Place((1, begin), begin, end))
            elif i or not plus:
                stretch.append((begin, end))
                continue
            # What follows a plus belongs to no number.
            stretches.append(stretch)
            stretch = []
        stretches.append(stretch)
    return alone, [s for s in stretches if s]


def _sums(stretch: list[tuple[int, int]]) -> list[Place]:
    """Neighbouring groups that have 13 to 19 digits together: groups of three and more, or the whole stretch."""
    found = []
    for i in range(len(stretch)):
        widths: list[int] = []
        for j in range(i, len(stretch)):
            widths.append(stretch[j][1] - stretch[j][0])
            total = sum(widths)
            if total > 19:
                break
            if total >= 13 and (min(widths) >= 3 or len(widths) == len(stretch)):
                begin, end = stretch[i][0], stretch[j][1]
                found.append(Place((2 if tuple(widths) in CARDS else 4, -total, begin), begin, end, _has_luhn))
    return found


class Places:
    """IBANs, numbers and telephone numbers of a text in which other values are blanked."""

    def __init__(self, text: str):
        self.text = text
        self.used = bytearray(len(text))
        self.chosen: list[Place] = []
        ibans = _ibans(text)
        self._choose(ibans)
        alone, stretches = _groups(self._left())
        self._choose(alone)
        sums = [place for stretch in stretches for place in _sums(stretch)]
        self._choose([place for place in sums if place.rank[0] == 2])
        self._choose(_phones(self._left()))
        self._choose([place for place in sums if place.rank[0] == 4])
        self._choose([place for stretch in stretches for place in self._pieces(stretch)])
        self.chosen.sort(key=lambda place: place.begin)
        self.tested = sorted(ibans + sums, key=lambda place: place.begin)

    def _left(self) -> str:
        return _blank(self.text, [(place.begin, place.end) for place in self.chosen])

    def _choose(self, places: list[Place]) -> None:
        for place in sorted(places, key=lambda place: place.rank):
            if not any(self.used[place.begin : place.end]) and (place.valid is None or place.valid(self.text[place.begin : place.end])):
                self.used[place.begin : place.end] = b"\1" * (place.end - place.begin)
                self.chosen.append(place)

    def _pieces(self, stretch: list[tuple[int, int]]) -> Iterator[Place]:
        """What is left between values, if it has 13 to 19 digits: a number without a check digit."""
        piece: list[tuple[int, int]] = []
        for group in [*stretch, None]:
            if group and not any(self.used[group[0] : group[1]]):
                piece.append(group)
                continue
            if 13 <= sum(end - begin for begin, end in piece) <= 19:
                yield Place((5, piece[0][0]), piece[0][0], piece[-1][1])
            piece = []

    @staticmethod
    def _near(places: list[Place], begin: int, end: int) -> Iterator[Place]:
        for place in places[bisect_left(places, begin - REACH, key=lambda p: p.begin) : bisect_left(places, end, key=lambda p: p.begin)]:
            if place.end > begin:
                yield place

    def _rivals(self, own: Place) -> list[Place]:
        """What would take the place of ``own``, or of a part of it, if it became valid."""
        return [
            place for place in self._near(self.tested, own.begin, own.end)
            if place.rank < own.rank and not any(other.rank < place.rank for other in self._near(self.chosen, place.begin, place.end))
        ]

    def pseudonyms(self, feistel: Feistel, back: bool) -> Iterator[tuple[int, int, str, str]]:
        """A pseudonym that would make a rival valid is walked on, or the text would be read otherwise on the way back.

        The values are taken in order, and in reverse on the way back, so a rival is judged by the same neighbours.
        """
        state = list(self.text) if self.chosen else []
        for own in reversed(self.chosen) if back else self.chosen:
            kind, pseudonym = PSEUDONYMS[own.rank[0]]
            rivals = self._rivals(own)
            while True:
                value = pseudonym("".join(state[own.begin : own.end]), feistel, back)
                state[own.begin : own.end] = value
                if not any(rival.valid("".join(state[rival.begin : rival.end])) for rival in rivals):
                    break
            yield own.begin, own.end, kind, value


class Pseudonyms:
    """Finds and replaces the personal data of one text."""

    def __init__(self, key: bytes = DEFAULT_KEY):
        self.feistel = Feistel(key)

    def spans(self, text: str, back: bool = False) -> list[tuple[int, int, str, str]]:
        """(begin, end, kind, pseudonym) of every value, in order and without overlaps."""
        found: list[tuple[int, int, str, str]] = []
        taken: list[tuple[int, int]] = []
        used = bytearray(len(text))

        def add(begin: int, end: int, kind: str, pseudonym: str | None) -> None:
            if pseudonym is not None:
                used[begin:end] = b"\1" * (end - begin)
                taken.append((begin, end))
                found.append((begin, end, kind, pseudonym))

        if "@" in text:
            for match in EMAIL.finditer(text):
                add(*match.span(), "email", _email(match.group(), self.feistel, back))
        if CANDIDATE.search(text):
            for kind, pattern, pseudonym in FOUND:
                for match in pattern.finditer(text):
                    if used.find(1, *match.span()) < 0:
                        add(*match.span(), kind, pseudonym(match.group(), self.feistel, back))
            found += Places(_blank(text, taken)).pseudonyms(self.feistel, back)
        return sorted(found)

    def replace(self, text: str, back: bool = False) -> tuple[str, list[tuple[int, int, str, str]]]:
        spans = self.spans(text, back)
        parts, last = [], 0
        for begin, end, _, pseudonym in spans:
            parts += [text[last:begin], pseudonym]
            last = end
        return "".join([*parts, text[last:]]) if spans else text, spans


SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def pseudonymise(df: DataFrame, text: str = "text", key: bytes = DEFAULT_KEY, spans: str | None = None, back: bool = False) -> DataFrame:
    """The rows, all columns, with pseudonyms in the text; ``spans`` names an added column of what was replaced.

    Spans are those of the given text; only addresses (IPv4) may change their length. ``back`` restores the values.
    """
    kinds = "array<struct<begin:int,end:int,kind:string>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + (f", `{spans}` {kinds}" if spans else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key)
        for batch in small_batches(batches, text):
            at = batch.schema.get_field_index(text)
            texts, found = [], []
            for value in batch.column(text).to_pylist():
                value, own = (None, []) if value is None else pseudonyms.replace(value, back)
                texts.append(value)
                found.append([{"begin": b, "end": e, "kind": kind} for b, e, kind, _ in own])
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if spans:
                batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, SPANS)], names=[*batch.schema.names, spans])
            yield batch

    return df.mapInArrow(run, schema)


def key_of(spark: SparkSession) -> bytes:
    """The secret that the session names; the example key, which anyone can undo, where it names none."""
    return (spark.conf.get(KEY_SETTING, None) or DEFAULT_KEY.decode()).encode("utf-8")


@query("op9_pii_pseudonyms")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with pseudonyms, and what was replaced."""
    return pseudonymise(documents(spark, folder).select("doc_id", "text"), key=key_of(spark), spans="spans").selectExpr(
        "doc_id", "text", "spans", "cast(size(spans) AS bigint) AS n_replaced"
    )
