"""PII pseudonyms: validated numbers, dates and mail names are permuted under a key within their own format by a Feistel network."""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm.common import lean

ROUNDS = 8


def permuted(x: int, size: int, key: bytes, tweak: str, alike: Callable[[int], bool] = lambda _: True) -> int:
    """A keyed permutation of 0..size-1: a balanced Feistel network over the next even number of bits, walked until the value
    is in range and in the class ``alike``. Walking keeps it a permutation of that class, so x must be in it."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8
    prefix = tweak.encode() + b"\0" + size.to_bytes(16, "big")
    while True:
        left, right = x >> half, x & mask
        for i in range(ROUNDS):
            f = hashlib.blake2b(prefix + bytes([i]) + right.to_bytes(width, "big"), key=key, digest_size=max(8, width)).digest()
            left, right = right, left ^ (int.from_bytes(f, "big") & mask)
        x = left << half | right
        if x < size and alike(x):
            return x


def digits_of(text: str) -> str:
    return re.sub(r"\D", "", text)


def with_digits(text: str, digits: str) -> str:
    """The text with its digits replaced in order, all else as it is."""
    new = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(new), text)


def luhn_digit(body: str) -> str:
    """The check digit that makes body and digit pass the Luhn test."""
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(body))))
    return str(-total % 10)


def card(text: str, key: bytes) -> str | None:
    """Luhn-valid numbers of 13 to 19 digits: the first digit stays, the others are permuted, the check digit follows."""
    digits = digits_of(text)
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    n = len(digits) - 2
    body = digits[0] + str(permuted(int(digits[1:-1]), 10**n, key, f"card{digits[0]}")).zfill(n)
    return with_digits(text, body + luhn_digit(body))


def iban(text: str, key: bytes) -> str | None:
    """Numbers that pass the mod-97 test: the country stays, digits of the account are permuted, check digits follow."""
    compact = text.replace(" ", "").upper()
    value = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(compact) <= 34 or value(compact[4:] + compact[:4]) % 97 != 1:
        return None
    digits = digits_of(compact[4:])
    account = with_digits(compact[4:], str(permuted(int(digits), 10 ** len(digits), key, "iban" + compact[:2])).zfill(len(digits))) if digits else compact[4:]
    check = 98 - value(account + compact[:2] + "00") % 97
    new = iter(compact[:2] + str(check).zfill(2) + account)
    return re.sub(r"\S", lambda _: next(new), text)


def ssn(text: str, key: bytes) -> str | None:
    """Valid US social security numbers to valid ones."""

    def valid(x: int) -> bool:
        area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    x = int(digits_of(text))
    return with_digits(text, str(permuted(x, 10**9, key, "ssn", valid)).zfill(9)) if valid(x) else None


def address(text: str, key: bytes) -> str | None:
    """IPv4 addresses to addresses, as dotted numbers of 0 to 255 without leading zeros."""
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or text != ".".join(map(str, parts)):
        return None
    return ".".join(map(str, permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip").to_bytes(4, "big")))


#: Calling codes of countries: these of one and of two digits, all others of three (ITU-T E.164). Fixed values.
SHORT_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def phone(text: str, key: bytes) -> str | None:
    """Numbers of 8 to 15 digits with a calling code, which stays, or of 10 without: these are North American, as with +1.

    The number is read from its digits alone, so separators and a trunk "(0)" do not change its pseudonym. North American
    numbers stay valid as such.
    """
    shown = text.replace("(0)", "(\0)")
    digits = digits_of(shown)
    if text.startswith("+"):
        code = next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3])
        head, rest = code, digits[len(code) :]
        if not 8 <= len(digits) <= 15:
            return None
    else:
        code, head, rest = "1", "", digits
        if len(digits) != 10:
            return None
    american = len(rest) == 10 and code == "1"

    def valid(x: int) -> bool:
        """Whether area and exchange code begin with 2 to 9."""
        return not american or (x // 10**9 > 1 and x // 10**6 % 10 > 1)

    x = int(rest)
    kind = valid(x)
    new = permuted(x, 10 ** len(rest), key, "phone" + code, lambda y: valid(y) == kind)
    return with_digits(shown, head + str(new).zfill(len(rest))).replace("\0", "0")


FIRST_DAY, DAYS = datetime.date(1900, 1, 1), (datetime.date(2100, 1, 1) - datetime.date(1900, 1, 1)).days
#: Separator, and places of year, month and day in the parts of a date.
DATES = {"-": (0, 1, 2), "/": (2, 1, 0), ".": (2, 1, 0)}


def date_class(day: datetime.date) -> tuple[int, bool]:
    """What a date's pseudonym shares with it, so that it fits wherever the date can be written: whether the day has one digit
    or can be a month, and whether the month has one digit."""
    return (day.day > 9) + (day.day > 12), day.month > 9


def date(text: str, key: bytes) -> str | None:
    """Days from 1900 to 2099 as 2001-02-28, 28/02/2001, 28.2.2001 (and 02/28/2001 where that is the only reading) to others.

    The day is permuted, not its spelling: one day has one pseudonym in all forms, and each part keeps its width.
    """
    sep = next(c for c in text if not c.isdigit())
    parts = text.split(sep)
    place = DATES[sep]
    if sep == "/" and int(parts[1]) > 12:
        place = (2, 0, 1)
    try:
        day = datetime.date(*(int(parts[i]) for i in place))
    except ValueError:
        return None
    if not 0 <= (day - FIRST_DAY).days < DAYS:
        return None
    kind = date_class(day)
    new = FIRST_DAY + datetime.timedelta(permuted((day - FIRST_DAY).days, DAYS, key, "date", lambda n: date_class(FIRST_DAY + datetime.timedelta(n)) == kind))
    out = list(parts)
    for i, v in zip(place, (new.year, new.month, new.day), strict=True):
        out[i] = str(v).zfill(len(parts[i]))
    return sep.join(out)


def mail(text: str, key: bytes) -> str | None:
    """The name of a mail address: runs of letters and of digits are permuted among those of their length; the domain stays."""
    name, _, domain = text.rpartition("@")

    def run(m: re.Match[str]) -> str:
        s = m[0]
        if s.isdigit():
            return str(permuted(int(s), 10 ** len(s), key, "mail9")).zfill(len(s))
        x = 0
        for c in s.lower():
            x = x * 26 + ord(c) - 97
        x = permuted(x, 26 ** len(s), key, "maila")
        out = []
        for c in reversed(s):
            x, d = divmod(x, 26)
            out.append(chr(d + (65 if c.isupper() else 97)))
        return "".join(reversed(out))

    return re.sub("[A-Za-z]+|[0-9]+", run, name) + "@" + domain


#: How card numbers are written: one token, or groups with one separator.
CARD_FORM = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")
IBAN_FORM = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
TOKEN = re.compile(r"[A-Z0-9]+")


def stretches(run: str, most: int) -> Iterator[tuple[int, int]]:
    """The stretches of whole tokens in a run, of at most ``most`` letters and digits: from each token on, the longest first."""
    places = [m.span() for m in TOKEN.finditer(run)]
    for i, (a, _) in enumerate(places):
        ends, n = [], 0
        for c, b in places[i:]:
            n += b - c
            if n > most:
                break
            ends.append(b)
        yield from ((a, b) for b in reversed(ends))


def card_readings(run: str) -> Iterator[tuple[int, int]]:
    """Numbers as cards are written first, from the left, then what one greedy reading after another takes."""
    yield from (x for x in stretches(run, 19) if CARD_FORM.fullmatch(run, *x))
    yield from (m.span() for m in GREEDY_CARD.finditer(run))


def other_card_readings(run: str) -> Iterator[tuple[int, int]]:
    """All stretches of tokens, the longest first."""
    yield from sorted(stretches(run, 19), key=lambda x: (x[0] - x[1], x[0]))


def iban_readings(run: str) -> Iterator[tuple[int, int]]:
    yield from (x for x in stretches(run, 34) if IBAN_FORM.fullmatch(run, *x))


GREEDY_CARD = re.compile(r"(?<![0-9-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9-])")
#: A whole chain of tokens, in which a number may have neighbours.
CARD_RUN = re.compile(r"(?<![\w.-])(?=[0-9](?:[ -]?[0-9]){12})[0-9]+(?:[ -][0-9]+)*(?![\w-])", re.ASCII)
#: Kinds whose pattern gives a run: the stretches of it to check, in the order of preference. A stretch that is valid is taken.
READINGS: dict[str, list[Callable[[str], Iterator[tuple[int, int]]]]] = {"iban": [iban_readings], "card": [card_readings, other_card_readings]}

# Kinds in the order in which they claim a stretch of text: pattern, and what checks and replaces it (None: not valid). A kind
# that stands twice takes its next READINGS, from what the kinds between have left.
KINDS: list[tuple[str, str, re.Pattern[str], Callable[[str, bytes], str | None]]] = [
    ("email", "@", re.compile(r"(?<![\w.+%-])[A-Za-z0-9][\w.+%-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w-])", re.ASCII), mail),
    ("iban", "", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}[A-Z0-9]*(?: [A-Z0-9]+)*(?!\w)"), iban),
    ("card", "", CARD_RUN, card),
    ("ip", "", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.\w)"), address),
    ("ssn", "", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), ssn),
    ("date", "", re.compile(r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![\w/-]|\.[0-9])"), date),
    ("phone", "", re.compile(r"(?<![\w.+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([.-])[0-9]{3}\1[0-9]{4})(?!\w|[.-][0-9])"), phone),
    ("card", "", CARD_RUN, card),
]
DIGIT = re.compile("[0-9]")


def pseudonymized(text: str, key: bytes) -> tuple[str, list[str]]:
    """The text with every personal value replaced, and the kinds of the replaced values in their order."""
    if not DIGIT.search(text) and "@" not in text:
        return text, []
    taken: list[tuple[int, int, str, str]] = []
    claimed = bytearray(len(text))
    turn: dict[str, int] = {}
    for kind, needs, pattern, replace in KINDS:
        if needs not in text:
            continue
        readings = READINGS.get(kind, [lambda run: [(0, len(run))]])[turn.get(kind, 0)]
        turn[kind] = turn.get(kind, 0) + 1
        for m in pattern.finditer(text):
            for a, b in readings(m[0]):
                a, b = m.start() + a, m.start() + b
                if claimed.find(1, a, b) < 0:
                    new = replace(text[a:b], key)
                    if new is not None:
                        taken.append((a, b, kind, new))
                        claimed[a:b] = b"\1" * (b - a)
    out, at = [], 0
    taken.sort()
    for a, b, _, new in taken:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), [x[2] for x in taken]


def pseudonymize(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_private, kinds): every text with its personal values replaced, how many, and the kinds found, sorted.

    Replaced are mail names, IBANs, payment cards, IPv4 addresses, US social security numbers, dates and phone numbers that
    pass the checks of their kind; where a chain of number tokens fails as a whole, shorter stretches of its tokens are tried,
    so a neighbour (an expiry, a list number) hides no card or IBAN, and a table of bare numbers may hold some by chance. Each becomes another valid value of its format. The same value has the same pseudonym in
    every text under one key, and two values never share one, whatever separators they are written with. Null stays null with nothing found; empty stays empty. Equal rows come
    out as often as they come in; a null doc_id stays null; other columns are ignored. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pseudonymized(x.as_py(), key) if x.is_valid else (None, []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([",".join(sorted(set(r[1]))) for r in rows], pa.string())],
                ["doc_id", "text", "n_private", "kinds"],
            )

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, text string, n_private long, kinds string")
