"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation inside each format.

A value found in a text is first validated (check digits, calendar, ranges), so look-alikes stay as
they are. Its free positions are read as one number below the size of the format, a Feistel network
keyed with the caller's key permutes that number, and cycle walking keeps it inside the format. Check
digits are made anew and separators and letter case stay, so a pseudonym is valid like the original,
and equal values get equal pseudonyms in all documents, however they are written. Whoever has the
key can turn the texts back (``reverse=True``). As in any permutation, a value can be its own image;
for a format of n values the chance is 1/n.

Formats: e-mail addresses (the local part), payment card numbers (Luhn), IBANs (mod 97), US social
security numbers, phone numbers (all but the country code; without one only if area code and exchange
begin with 2 to 9, or behind a word such as "phone"), IPv4 addresses (not behind a word such as "version"), calendar dates from 1900
to 2099 (any of ISO, alone or before ``T`` and a time, day.month.year and month/day/year, or
day/month/year where the first part is above 12) and secrets in assignments such as ``token = "..."``
or ``CLIENT_SECRET=...``. Days above 12 stay above 12, so that slashed dates are read the same way
when turned back. A null text stays null with count 0; whole texts are searched whatever their length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import date

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import append

ROUNDS = 10
KINDS = ("email", "secret", "iban", "date", "ipv4", "ssn", "card", "phone")

# Alphabets whose letters replace each other.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"
LATIN_LOWER = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"

# Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22,
    "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27,
    "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MT": 31, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = re.compile(r"(?P<email>(?<![\w.+%-])[\w.+%-]{1,256}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
SECRET = re.compile(
    r"(?P<secret>(?i:(?<![^\W_])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b)[^A-Za-z0-9\n]{0,12}[=:]"
    r"[^A-Za-z0-9\n]{0,12}[A-Za-z0-9+/_-]{12,})")
NUMBER = re.compile(
    r"(?=[0-9+(A-Z])(?:"
    r"(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})"
    r"|(?P<date>(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9]{2}(?::|[0-9]{2}|Z|\b))"
    r"|(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"
    r"(?![\w/-]|\.[0-9])))"
    rf"|(?P<ipv4>(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?!\w|\.[0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w+-])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}"
    r"|[0-9]{4}(?P<gap2>[ -])[0-9]{6}(?P=gap2)[0-9]{5})(?!\w))"
    r"|(?P<phone>(?<![\w+])(?:(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"|\+[0-9]{1,3}(?:[ -]?(?:\([0-9]{1,4}\)|[0-9]{2,4})){2,4}|\+[0-9]{7,15})(?!\w|\.[0-9])))"
)
DIGIT = re.compile("[0-9]")
#: What may stand before a number that is no address, and before one that is a phone number whatever its digits.
VERSION_WORD = re.compile(r"(?i)(?<![a-z])(?:v|ver|version|release|build|section|chapter|rev|revision)[ .:#-]{0,3}$")
PHONE_WORD = re.compile(r"(?i)(?<![a-z])(?:phone|telephone|tel|mobile|cell|fax|call|whatsapp)(?: ?(?:number|no))?[ .:#(-]{0,3}$")
CUE_REACH = 24
SECRET_WORD = re.compile("(?i)token|secret|passw|key")
WORTH_A_SEARCH = r"[0-9@]|(?i:token|secret|passw|key)[^\n]{0,16}[=:]"


class Permutation:
    """A keyed permutation of the numbers below any size."""

    def __init__(self, key: bytes, reverse: bool = False):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.reverse = reverse

    def _mix(self, tweak: bytes, round_: int, value: int, bits: int) -> int:
        size = bits // 8 + 1
        message = round_.to_bytes(1, "big") + value.to_bytes(size, "big") + tweak
        return int.from_bytes(hashlib.shake_256(self.key + message).digest(size), "big") & ((1 << bits) - 1)

    def _once(self, value: int, bits: int, tweak: bytes) -> int:
        left, right = value >> bits, value & ((1 << bits) - 1)
        if self.reverse:
            for r in reversed(range(ROUNDS)):
                left, right = right ^ self._mix(tweak, r, left, bits), left
        else:
            for r in range(ROUNDS):
                left, right = right, left ^ self._mix(tweak, r, right, bits)
        return left << bits | right

    def __call__(self, value: int, size: int, tweak: str, valid: Callable[[int], bool] = lambda _: True) -> int:
        """The image of a number among the valid numbers below ``size``; ``value`` must be one of them."""
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            value = self._once(value, bits, f"{tweak}:{size}".encode())
            if value < size and valid(value):
                return value


def luhn_digit(body: str) -> str:
    """Check digit that makes ``body`` and itself a valid number."""
    doubled = (int(c) * 2 for c in body[::-2])
    return str(-(sum(d - 9 * (d > 9) for d in doubled) + sum(map(int, body[-2::-2]))) % 10)


def iban_digits(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def _refilled(shape: str, characters: str, held: str) -> str:
    """``shape`` with its characters that stand in ``held`` replaced, in order, by ``characters``."""
    fresh = iter(characters)
    return "".join(next(fresh) if c in held else c for c in shape)


def _alphabets(value: str, secret: bool) -> list[str]:
    """Alphabet of each character: the characters that may stand in its place."""
    if secret and all(c in HEX for c in value):
        return [HEX] * len(value)
    return [next((a for a in (DIGITS, LOWER, LATIN_LOWER) if c in a), c) for c in value]


def _permuted_text(value: str, tweak: str, permute: Permutation) -> str:
    """Every letter and digit replaced within its alphabet; case stays and makes no difference."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    alphabets = _alphabets(low, tweak == "secret")
    number, size = 0, 1
    for c, a in zip(low, alphabets, strict=True):
        number, size = number * len(a) + a.index(c), size * len(a)
    if size == 1:
        return value
    shape = "".join(str(min(len(a), 99)) + "," for a in alphabets)
    number = permute(number, size, f"{tweak}:{shape}")
    out = []
    for a in reversed(alphabets):
        number, place = divmod(number, len(a))
        out.append(a[place])
    made = out[::-1]
    if len(set(alphabets)) == 1 and alphabets[0] == HEX:
        return "".join(made) if value == low else "".join(made).upper()
    return "".join(m.upper() if c != l else m for c, l, m in zip(value, low, made, strict=True))


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _card(found: str, permute: Permutation) -> str | None:
    digits = _digits(found)
    if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    n = len(digits) - 1
    body = f"{permute(int(digits[:-1]), 10 ** n, 'card', bool):0{n}d}"
    return _refilled(found, body + luhn_digit(body), DIGITS)


def _iban(found: str, permute: Permutation) -> str | None:
    plain = found.replace(" ", "")
    country, account = plain[:2], plain[4:]
    if iban_digits(country, account) != plain[2:4]:
        return None
    made = _permuted_text(account, f"iban:{country}", permute).upper()
    return _refilled(found, country + iban_digits(country, made) + made, DIGITS + LOWER.upper())


def _ssn_valid(number: int) -> bool:
    area, group, serial = number // 10 ** 6, number // 10 ** 4 % 100, number % 10 ** 4
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _ssn(found: str, permute: Permutation) -> str | None:
    number = int(_digits(found))
    if not _ssn_valid(number):
        return None
    return _refilled(found, f"{permute(number, 10 ** 9, 'ssn', _ssn_valid):09d}", DIGITS)


def _dialled(number: int) -> bool:
    """Whether area code and exchange of a number of ten digits can be: neither begins with 0 or 1."""
    return number // 10 ** 9 > 1 and number // 10 ** 6 % 10 > 1


def _phone(found: str, permute: Permutation, before: str = "") -> str | None:
    digits = _digits(found)
    country = (1 if digits[0] in "17" else 2) if found.startswith("+") else len(digits) - 10
    n = len(digits) - country
    if not 7 <= len(digits) <= 15 or n < 6:
        return None
    number = int(digits[country:])
    if found.startswith("+"):
        made = permute(number, 10 ** n, f"phone:{n}")
    else:
        own = _dialled(number)
        if not own and not PHONE_WORD.search(before):
            return None
        made = permute(number, 10 ** n, f"phone:{n}:{own}", lambda other: _dialled(other) == own)
    return _refilled(found, digits[:country] + f"{made:0{n}d}", DIGITS)


def _ipv4(found: str, permute: Permutation, before: str = "") -> str | None:
    if VERSION_WORD.search(before):
        return None
    number = int.from_bytes(bytes(map(int, found.split("."))), "big")
    return ".".join(map(str, permute(number, 1 << 32, "ipv4").to_bytes(4, "big")))


FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def _day_class(day: int) -> tuple[bool, bool]:
    """Whether a part has one digit, and whether the day of the month cannot be a month."""
    that = date.fromordinal(FIRST_DAY + day)
    return that.day < 10 or that.month < 10, that.day > 12


def _date(found: str, permute: Permutation) -> str | None:
    mark = "-" if "-" in found else "." if "." in found else "/"
    order = {"-": (0, 1, 2), ".": (2, 1, 0), "/": (2, 0, 1)}[mark]  # where year, month and day stand
    parts = found.split(mark)
    if mark == "/" and int(parts[0]) > 12:
        order = (2, 1, 0)
    try:
        day = date(*(int(parts[i]) for i in order)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    # Days of a class stay among themselves, so that it remains visible whether zeros are written and which part is the day.
    own = _day_class(day - FIRST_DAY)
    fresh = date.fromordinal(FIRST_DAY + permute(
        day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, f"date:{own}", lambda n: n <= LAST_DAY - FIRST_DAY and _day_class(n) == own))
    padded = all(len(p) >= 2 for p in parts)
    values = (fresh.year, fresh.month, fresh.day)
    made = [""] * 3
    for value, place in zip(values, order, strict=True):
        made[place] = f"{value:02d}" if padded else str(value)
    return mark.join(made)


def _email(found: str, permute: Permutation) -> str:
    local, _, domain = found.partition("@")
    return f"{_permuted_text(local, f'email:{domain.lower()}', permute)}@{domain}"


def _secret(found: str, permute: Permutation) -> str:
    value = re.search(r"[A-Za-z0-9+/_-]{12,}$", found)[0]
    return found[:len(found) - len(value)] + _permuted_text(value, "secret", permute)


MAKERS = {"email": _email, "secret": _secret, "iban": _iban, "date": _date, "ipv4": _ipv4, "ssn": _ssn, "card": _card,
          "phone": _phone}
WITH_CUES = ("phone", "ipv4")


def replaced(text: str, permute: Permutation, kinds: tuple[str, ...] = KINDS) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kind of each value replaced, in order."""
    out, done = [], []
    for line in text.split("\n"):
        at, parts = 0, []
        for start, end, kind in _found(line):
            made = None
            if kind in kinds:
                cue = (line[max(0, start - CUE_REACH):start],) if kind in WITH_CUES else ()
                made = MAKERS[kind](line[start:end], permute, *cue)
            if made is not None:
                done.append(kind)
                parts += [line[at:start], made]
                at = end
        out.append("".join([*parts, line[at:]]) if parts else line)
    return "\n".join(out), done


def _kind(match: re.Match) -> str:
    return next(kind for kind in KINDS if match.groupdict().get(kind))


def _end(match: re.Match, line: str) -> int:
    """Where the value ends; an IBAN has the length of its country and ends at a word's end, or is none."""
    if not match.groupdict().get("iban"):
        return match.end()
    end, left = match.start(), IBAN_LENGTHS.get(match[0][:2], 0)
    while left and end < match.end():
        left -= line[end] != " "
        end += 1
    whole = not left and not (line[end:end + 1].isalnum() or line[end:end + 1] == "_")
    return end if whole and end > match.start() else match.start() + 2


def _found(line: str) -> list[tuple[int, int, str]]:
    """Ranges and kinds of what looks like a value, in order; of overlapping ones the first, then the longest."""
    found = []
    for pattern, wanted in ((EMAIL, "@" in line), (SECRET, SECRET_WORD.search(line)), (NUMBER, DIGIT.search(line))):
        at = 0
        while wanted and (match := pattern.search(line, at)):
            at = _end(match, line)
            found.append((match.start(), -at, _kind(match)))
    out: list[tuple[int, int, str]] = []
    for start, end, kind in sorted(found):
        if not out or start >= out[-1][1]:
            out.append((start, -end, kind))
    return out


def pseudonymise(df: DataFrame, text: str, key: bytes, kinds: tuple[str, ...] = KINDS, reverse: bool = False) -> DataFrame:
    """The frame with pseudonyms in ``text`` and ``pii_kinds``, the kind of each value replaced, in order.

    The text column keeps its place; a column named ``pii_kinds`` is replaced. With ``reverse`` the
    same key turns pseudonyms back.
    """

    def make():
        permute = Permutation(key, reverse)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            values = batch.column(text)
            search = pc.match_substring_regex(values, WORTH_A_SEARCH).fill_null(False).to_numpy(zero_copy_only=False)
            texts = values.to_pylist()
            found: list[list[str]] = [[] for _ in texts]
            for row in search.nonzero()[0]:
                texts[row], found[row] = replaced(texts[row], permute, kinds)
            return [pa.array(texts, pa.string()), pa.array(found, pa.list_(pa.string()))]

        return work

    name = "`" + text.replace("`", "``") + "`"
    out = append(df, f"{name} string, pii_kinds array<string>", make)
    order = [c for c in df.columns if c.lower() != "pii_kinds"]
    return out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in order], "pii_kinds")
