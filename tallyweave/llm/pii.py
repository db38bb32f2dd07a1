"""Personal data replaced by pseudonyms of the same format.

Numbers and dates that pass their format's own check are permuted by a keyed
Feistel network over exactly the values of that format: a card number becomes
another that passes its check digit, a date another date. The permutation
depends on the key and the kind only, so equal values stay equal in all
documents, and the holder of the key can invert it.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import textops

RESULT = "doc_id long, text string, found array<struct<start:int,end:int,kind:string>>"

ROUNDS = 8

#: Days that dates are permuted among. Fixed values.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: Month names in the order of the year, by language. Fixed values.
MONTHS = {
    "en": ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"),
    "de": ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"),
    "fr": ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"),
    "es": ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
}
#: How each language writes day d, month m and year y. Fixed values.
WORDED = {"en": "{d} {m} {y}", "us": "{m} {d}, {y}", "de": "{d}. {m} {y}", "fr": "{d} {m} {y}", "es": "{d} de {m} de {y}"}


class Permutation:
    """A keyed bijection of range(size), by an alternating Feistel network with cycle walking."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size, self.key, self.tweak = size, key, f"{kind}:{size}".encode()
        self.a = math.isqrt(max(size, 1) - 1) + 1  # the whole root, rounded up
        self.b = -(-size // self.a)

    def _round(self, i: int, x: int) -> int:
        digest = hashlib.blake2b(b"%s|%d|%d" % (self.tweak, i, x), key=self.key[:64], digest_size=16).digest()
        return int.from_bytes(digest, "little")

    def forward(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.b)
            for i in range(ROUNDS):
                if i % 2:
                    right = (right + self._round(i, left)) % self.b
                else:
                    left = (left + self._round(i, right)) % self.a
            x = left * self.b + right
            if x < self.size:
                return x

    def backward(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.b)
            for i in reversed(range(ROUNDS)):
                if i % 2:
                    right = (right - self._round(i, left)) % self.b
                else:
                    left = (left - self._round(i, right)) % self.a
            x = left * self.b + right
            if x < self.size:
                return x


def luhn_digit(digits: str) -> str:
    """The check digit that makes digits + it valid."""
    total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return str(-total % 10)


def _iban_rest(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def _refill(shape: str, digits: str) -> str:
    """The shape's digits replaced in turn."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in shape)


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


class Pseudonyms:
    """The replacement of each kind of value; None where a value fails its check."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.way = key, "backward" if inverse else "forward"
        self.made: dict[tuple[str, int], Permutation] = {}

    def permute(self, kind: str, size: int, x: int) -> int:
        p = self.made.get((kind, size)) or self.made.setdefault((kind, size), Permutation(self.key, kind, size))
        return getattr(p, self.way)(x)

    def _number(self, kind: str, digits: str) -> str:
        return str(self.permute(kind, 10 ** len(digits), int(digits))).zfill(len(digits)) if digits else ""

    def card(self, m: re.Match) -> str | None:
        d = _digits(m[0])
        if luhn_digit(d[:-1]) != d[-1]:
            return None
        body = self._number("card", d[:-1])
        return _refill(m[0], body + luhn_digit(body))

    def iban(self, m: re.Match) -> str | None:
        s = m[0].replace(" ", "")
        if not 15 <= len(s) <= 34 or _iban_rest(s) != 1:
            return None
        body = s[4:]
        letters = [c for c in body if c.isalpha()]
        digits = self._number("iban", _digits(body))
        word = self.permute("iban letters", 26 ** len(letters), _from_letters(letters)) if letters else 0
        it, jt = iter(digits), iter(_to_letters(word, len(letters)))
        body = "".join(next(jt) if c.isalpha() else next(it) for c in body)
        s = s[:2] + f"{98 - _iban_rest(s[:2] + '00' + body):02d}" + body
        it = iter(s)
        return "".join(c if c == " " else next(it) for c in m[0])

    def ip(self, m: re.Match) -> str | None:
        parts = [int(x) for x in m[0].split(".")]
        if max(parts) > 255:
            return None
        x = self.permute("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = (int(x) for x in m[0].split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        area -= (area > 666) + 1
        x = self.permute("ssn", 898 * 99 * 9999, (area * 99 + group - 1) * 9999 + serial - 1)
        area, x = divmod(x, 99 * 9999)
        area += 1 + (area >= 665)
        return f"{area:03d}-{x // 9999 + 1:02d}-{x % 9999 + 1:04d}"

    def phone(self, m: re.Match) -> str | None:
        d = _digits(m[0])
        if not 8 <= len(d) <= 15:
            return None
        n = len(_digits(m["country"] or m["abroad"] or ""))
        return _refill(m[0], d[:n] + self._number("phone", d[n:]))

    def email(self, m: re.Match) -> str | None:
        """Each letter of the name becomes one of its own alphabet and case, so the letters together are a number of mixed radix."""
        local = m["local"]
        letters = [_alphabet(c) for c in local if c.isalpha()]
        size, word = 1, 0
        for alphabet, at, _ in letters:
            size, word = size * len(alphabet), word * len(alphabet) + at
        word, made = self.permute("email letters", size, word) if letters else 0, []
        for alphabet, _, upper in reversed(letters):
            word, at = divmod(word, len(alphabet))
            made.append(alphabet[at].upper() if upper else alphabet[at])
        it, jt = iter(self._number("email", _digits(local))), reversed(made)
        return "".join((next(jt) if c.isalpha() else next(it) if "0" <= c <= "9" else c) for c in local) + m[0][len(local) :]

    def date(self, m: re.Match) -> str | None:
        found = _read_date(m)
        if found is None:
            return None
        day, write, same_format = found
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        while True:  # walk on to a day that reads back in the same format
            day = self.permute("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY) + FIRST_DAY
            new = datetime.date.fromordinal(day)
            if same_format(new):
                return write(new)


def _from_letters(letters: list[str]) -> int:
    x = 0
    for c in letters:
        x = x * 26 + ord(c.lower()) - 97
    return x


def _to_letters(x: int, n: int) -> str:
    out = []
    for _ in range(n):
        x, r = divmod(x, 26)
        out.append(chr(65 + r))
    return "".join(reversed(out))


@functools.cache
def _alphabet(c: str) -> tuple[str, int, bool]:
    """The alphabet a letter is permuted in, its place there, and whether it is an A-Z, which shares the alphabet of a-z.

    Letters beyond have those of their 128 code points and category that stay
    one letter.
    """
    if c.isascii():
        return "abcdefghijklmnopqrstuvwxyz", ord(c.lower()) - 97, c.isupper()
    first = ord(c) & ~127
    alike = "".join(x for x in map(chr, range(first, first + 128)) if x.isalpha() and unicodedata.category(x) == unicodedata.category(c))
    return alike, alike.index(c), False


def _day(y: int, m: int, d: int) -> int | None:
    try:
        return datetime.date(y, m, d).toordinal()
    except ValueError:
        return None


def _read_date(m: re.Match) -> tuple[int, Callable, Callable] | None:
    """The day's number, how to write another day in the same format, and which days that format can hold."""
    s = m[0]
    every = lambda d: True
    if m["iso"]:
        sep = s[4]
        day = _day(int(s[:4]), int(s[5:7]), int(s[8:]))
        return day and (day, lambda d: f"{d.year:04d}{sep}{d.month:02d}{sep}{d.day:02d}", every)
    if m["plain"]:
        sep = re.search("[./-]", s)[0]
        a, b, y = s.split(sep)
        pad = 2 if len(a) == len(b) == 2 else 1
        for first in (True, False):  # day first if the calendar allows it
            if day := _day(int(y), int(b if first else a), int(a if first else b)):
                write = lambda d, f=first: f"{(d.day if f else d.month):0{pad}d}{sep}{(d.month if f else d.day):0{pad}d}{sep}{d.year:04d}"
                return day, write, lambda d, f=first: (f or d.day > 12) and (pad == 2 or min(d.day, d.month) < 10)
        return None
    way = next(w for w in WORDED if m[w])
    names = MONTHS["en" if way == "us" else way]
    month = names.index(re.search("|".join(names), s)[0])
    numbers = [int(x) for x in re.findall("[0-9]+", s)]
    day = _day(numbers[1], month + 1, numbers[0])
    return day and (day, lambda d: WORDED[way].format(d=d.day, m=names[d.month - 1], y=f"{d.year:04d}"), every)


def _worded() -> str:
    """One named group for each way to write a date with the month's name."""
    parts = []
    for way, form in WORDED.items():
        names = "|".join(MONTHS["en" if way == "us" else way])
        form = form.replace(".", r"\.").replace(" ", r"\x20")
        parts.append(f"(?P<{way}>" + form.format(d="[0-9]{1,2}", m=f"(?:{names})", y="[0-9]{4}") + ")")
    return "|".join(parts)


#: The formats, tried in this order at each place.
FORMATS = re.compile(
    rf"""
    (?P<email>(?<![\w.+%-])(?P<local>[\w.+%-]{{1,64}})@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)
  | (?<![\w.+-])(?:
      (?P<iban>[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?(?!\w))
    | (?P<ip>[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?!\w|\.[0-9]))
    | (?P<date>(?P<iso>[0-9]{{4}}(?P<sep>[-/.])[0-9]{{2}}(?P=sep)[0-9]{{2}})(?![\w-])
        | (?P<plain>[0-9]{{1,2}}(?P<sep2>[/.-])[0-9]{{1,2}}(?P=sep2)[0-9]{{4}})(?![\w-])
        | (?:{_worded()})(?!\w))
    | (?P<ssn>[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![\w-]))
    | (?P<card>(?:[0-9]{{13,19}}|[0-9]{{4}}(?P<gap>[\x20-])[0-9]{{4}}(?P=gap)[0-9]{{4}}(?P=gap)[0-9]{{1,7}}|[0-9]{{4}}[\x20-][0-9]{{6}}[\x20-][0-9]{{5}})(?![\w-]))
    )
  | (?P<phone>(?<![\w.])(?:(?P<country>\+[0-9]{{1,3}}[\x20.-]?)?(?:\([0-9]{{2,4}}\)|[0-9]{{3}})[\x20.-]?[0-9]{{3}}[\x20.-][0-9]{{4}}(?![\w-])
        | (?P<abroad>\+[0-9]{{1,3}})(?:[\x20.-](?:\([0-9]{{1,5}}\)|[0-9]{{1,8}})){{2,5}}(?![\w-])))
    """,
    re.X,
)
KINDS = ("email", "iban", "ip", "date", "ssn", "card", "phone")
#: Every format has an at sign, two digits in a row, or (an address of short parts) digits around a dot.
_HINT = re.compile(r"@|[0-9]{2}|[0-9]\.[0-9]")


def _replace(names: Pseudonyms, text: str) -> tuple[str, list[dict]]:
    found, out, at, start = [], [], 0, 0
    while m := FORMATS.search(text, start):
        kind = next(k for k in KINDS if m[k] is not None)
        new = getattr(names, kind)(m)
        start = m.end()
        if new is None:  # what fails one check may begin another format further on
            start = m.start() + 1
            while start < m.end() and (text[start - 1].isalnum() and text[start].isalnum()):
                start += 1
            continue
        out += [text[at : m.start()], new]
        at = m.end()
        found.append({"start": m.start(), "end": m.end(), "kind": kind})
    return "".join([*out, text[at:]]), found


def pseudonymise(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text", inverse: bool = False) -> DataFrame:
    """doc_id, the text with pseudonyms, and where in the given text each value stood (code points, ends exclusive).

    A null text stays null and has no finds; an empty one stays empty. Every
    row is treated by itself, whether its doc_id is null or repeated, and a long
    text whole. An empty table gives an empty result; columns other than id and
    text are ignored. With inverse, pseudonyms that this key made are turned
    back.

    Left as they are: numbers that fail their format's check, dates outside
    1900 to 2099 and dates with a month named in other languages than MONTHS
    has, phone numbers without a country sign that aren't grouped 3-3-4, and
    e-mail names of more than 64 characters. An e-mail's domain stays.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, inverse)
        for b in batches:
            texts, found = b.column(1).to_pylist(), []
            for i, t in enumerate(texts):
                spans = []
                if t and _HINT.search(t):
                    texts[i], spans = _replace(names, t)
                found.append(spans)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(found, kind)], names=["doc_id", "text", "found"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(textops.light(replace), RESULT)


def pseudonymise_rows(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The same rows and columns with pseudonyms in the text column, by the rules of pseudonymise()."""

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for b in batches:
            at = b.schema.get_field_index(text)
            texts = [_replace(names, t)[0] if t and _HINT.search(t) else t for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return docs.mapInArrow(textops.light(replace), docs.schema)
