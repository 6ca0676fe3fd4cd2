"""Pseudonyms for personal data by format-preserving Feistel permutations.

A value that passes the validation of its kind is numbered within its format, the number is permuted
by a keyed Feistel network (cycle-walking keeps it inside the format), and the result is written in
the same format.  The permutation depends on the key, the kind and the format alone, so equal values
get equal pseudonyms in all documents, and different values of one format different ones.

    card    13 to 19 digits with a valid check digit; digits before it are permuted, it is made anew
    iban    valid check digits; country stays, account characters are permuted within their class
    phone   +1 (ddd) ddd-dddd and international numbers of 8 to 15 digits; country prefix stays
    ssn     ddd-dd-dddd with valid parts
    ip      four numbers of 0 to 255, not right behind a v or the word version
    ip6     an IPv6 address with four groups or more and a digit, in any spelling; its pseudonym is in the short one
    date    a calendar day of 1900 to 2099: yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy or dd/mm/yyyy; the last three
            also with days and months of one digit, whose pseudonyms are written without zeros too
    email   letters and digits of the whole local part and of all host labels but the last
    secret  the whole value after token, secret, password or key (16 characters or more; hexadecimal
            values stay so), and access keys of the form AKIA and 16 letters and digits

Of a card, iban or phone the longest part from its start to an end of a group of letters or digits that
validates is taken, so what stands behind the value doesn't hide it; an iban's country length and the ten
digits of +1 and +7 go first.  Numbers that don't validate stay as they are.  Separators stay in place.

Defined results: null stays null; texts without personal data stay as they are.  A day that can be
read both ways is read month first.  Repeated rows get the same result.  The result is one struct
column, which replaces a column of its name; other columns pass through.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import worker_cache

RESULT = "text string, n_found int, kinds array<string>"
ROUNDS = 10
REMEMBERED = 100_000     # pseudonyms that a worker remembers
PIECE = 512              # characters permuted as one number; values up to that long are remembered

_DAY0 = dt.date(1900, 1, 1).toordinal()
_DAYS = dt.date(2100, 1, 1).toordinal() - _DAY0

# Character classes of free-form values (fixed values).
CLASSES = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
           "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"]
_CLASS = {c: k for k in CLASSES for c in k}
_HEX = {c: k for k in ("0123456789abcdef",) for c in k}
_UPPER = {c: k for k in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",) for c in k}

_LOCAL = r"[\w.+%-]"
EMAIL = re.compile(_LOCAL + r"++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])")
_LOCALS = re.compile(_LOCAL + "+")
PATTERN = re.compile(rf"(?P<email>(?<!{_LOCAL}){EMAIL.pattern})" + r"""
| (?P<secret>(?<![A-Za-z])(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s{0,3}[:=]\s{0,3}["']?(?P<value>[A-Za-z0-9+/_=.-]{16,}+))
| (?P<access>(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9]))
| (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
| (?P<ip6>(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:]))
| (?P<ip>(?<![0-9.])(?<!\b[Vv])(?<!\b[Vv]ersion\ )(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))
| (?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[./-][0-9]))
| (?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))
| (?P<phone>(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}|(?:\([0-9]{3}\)\ ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4})(?![0-9]))
| (?P<card>(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]))
""", re.VERBOSE)
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")
# What issued cards begin with, and their lengths.
ISSUED = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|(?:5\d|2[2-7]|35)\d{14}|3[47]\d{13}|3[0689]\d{12}|6\d{15,18}")
# Lengths of IBANs (fixed values of the registry).
IBAN_LENGTH = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
_MAY = re.compile(r"[0-9@]|(?i:token|secret|passw|key)|AKIA")


class Permuter:
    """Keyed permutations of 0 .. n - 1 for any n, by kind."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def permute(self, value: int, n: int, kind: str) -> int:
        if n < 2:
            return value
        half = ((n - 1).bit_length() + 1) // 2
        mask, size = (1 << half) - 1, (half + 7) // 8
        tweak = f"{kind}:{n}".encode()
        while True:
            left, right = value >> half, value & mask
            for r in range(ROUNDS):
                h = hashlib.blake2b(right.to_bytes(size, "big") + tweak, key=self.key, salt=bytes([r]),
                                    digest_size=min(64, max(8, size))).digest()
                left, right = right, left ^ (int.from_bytes(_stretch(h, size), "big") & mask)
            value = (left << half) | right
            if value < n:
                return value

    def characters(self, text: str, kind: str, classes: dict[str, str] = _CLASS) -> str:
        """Each letter or digit becomes one of its class.

        The text is permuted as one number; of a longer one than PIECE each piece is, by a permutation that
        depends on the piece's place and on the text before it.
        """
        out, before = [self._piece(text[:PIECE], kind, classes)], hashlib.blake2b(digest_size=16)
        for at in range(PIECE, len(text), PIECE):
            before.update(text[at - PIECE:at].encode("utf-8", "surrogatepass"))
            out.append(self._piece(text[at:at + PIECE], f"{kind}:{at}:{before.hexdigest()}", classes))
        return "".join(out)

    def _piece(self, text: str, kind: str, classes: dict[str, str]) -> str:
        value, n = 0, 1
        for c in text:
            if c in classes:
                k = classes[c]
                value, n = value * len(k) + k.index(c), n * len(k)
        value, out = self.permute(value, n, kind), []
        for c in reversed(text):
            if c in classes:
                k = classes[c]
                value, i = divmod(value, len(k))
                c = k[i]
            out.append(c)
        return "".join(reversed(out))


def _stretch(h: bytes, size: int) -> bytes:
    while len(h) < size:
        h += hashlib.blake2b(h, digest_size=64).digest()
    return h[:size]


def luhn(digits: str) -> int:
    """The check digit that makes these digits and it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def _into(shape: str, chars: str) -> str:
    """Letters and digits of ``shape`` replaced in order."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def card(p: Permuter, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if len(digits) < 13 or luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    body = p.characters(digits[:-1], "card")
    return _into(text, body + str(luhn(body)))


def iban(p: Permuter, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = p.characters(plain[4:], "iban" + plain[:2])
    check = 98 - _iban_number(body + plain[:2] + "00") % 97
    return _into(text, f"{plain[:2]}{check:02d}{body}")


def phone(p: Permuter, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if text[0] == "+":
        if not 8 <= len(digits) <= 15:
            return None
        prefix = 1 if digits[0] in "17" else 2
    else:
        prefix = 0
    return _into(text, digits[:prefix] + p.characters(digits[prefix:], "phone" + digits[:prefix]))


def _ssn_ok(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def ssn(p: Permuter, text: str) -> str | None:
    digits = text.replace("-", "")
    if not _ssn_ok(digits):
        return None
    while True:
        digits = p.characters(digits, "ssn")
        if _ssn_ok(digits):
            return _into(text, digits)


def ip(p: Permuter, text: str) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    value = p.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def ip6(p: Permuter, text: str) -> str | None:
    if sum(map(bool, text.split(":"))) < 4 or not re.search("[0-9]", text):
        return None
    try:
        value = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    while True:
        value = p.permute(value, 1 << 128, "ip6")
        new = str(ipaddress.IPv6Address(value))
        if sum(map(bool, new.split(":"))) >= 4 and re.search("[0-9]", new):
            return new.upper() if text.upper() == text else new


# Order of day, month and year in the forms of a date, by separator; the first that is a day counts.
_FORMS = {"-": ["ymd"], ".": ["dmy"], "/": ["mdy", "dmy"]}


def date(p: Permuter, text: str) -> str | None:
    sep = next(c for c in text if not c.isdigit())
    parts = text.split(sep)
    width = 1 if min(map(len, parts)) == 1 else 2
    for form in _FORMS[sep]:
        read = dict(zip(form, map(int, parts)))
        if not 1900 <= read["y"] <= 2099:
            continue
        try:
            day = dt.date(read["y"], read["m"], read["d"]).toordinal() - _DAY0
        except ValueError:
            continue
        new = dt.date.fromordinal(_DAY0 + p.permute(day, _DAYS, "date"))
        told = {"y": str(new.year), "m": f"{new.month:0{width}d}", "d": f"{new.day:0{width}d}"}
        return sep.join(told[c] for c in form)
    return None


def email(p: Permuter, text: str) -> str | None:
    cut = text.rindex(".")
    return p.characters(text[:cut], "email") + text[cut:]


def secret(p: Permuter, text: str) -> str | None:
    if re.fullmatch("[0-9a-f]+", text):
        return p.characters(text, "hex", _HEX)
    return p.characters(text, "secret")


def access(p: Permuter, text: str) -> str | None:
    return text[:4] + p.characters(text[4:], "access", _UPPER)


KINDS: dict[str, Callable[[Permuter, str], str | None]] = {
    "email": email, "iban": iban, "ip": ip, "ip6": ip6, "date": date, "ssn": ssn, "phone": phone, "card": card,
    "secret": secret, "access": access}


def _ends(kind: str, text: str, a: int, b: int) -> list[int]:
    """Ends of a match to try: where the format tells its length the one of that length, then the longest first."""
    if kind not in ("card", "iban", "phone"):
        return [b]
    ends = [b, *(e for e in range(b - 1, a, -1) if text[e - 1].isalnum() and not text[e].isalnum())]
    own = IBAN_LENGTH.get(text[a:a + 2]) if kind == "iban" else 11 if text[a:a + 2] in ("+1", "+7") else None
    if own:
        ends.sort(key=lambda e: sum(map(str.isalnum, text[a:e])) != own)
    return ends


class Masker:
    def __init__(self, key: bytes):
        self.permuter = Permuter(key)
        self.known: dict[tuple[str, str], str | None] = {}

    def pseudonym(self, kind: str, value: str) -> str | None:
        if len(value) > PIECE:
            return KINDS[kind](self.permuter, value)
        k = (kind, value)
        if k not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[k] = KINDS[kind](self.permuter, value)
        return self.known[k]

    def valid(self, kind: str, text: str, a: int, b: int) -> tuple[int, int, str] | None:
        """The span from ``a`` within a match that validates, and its pseudonym."""
        for e in _ends(kind, text, a, b):
            new = self.pseudonym(kind, text[a:e])
            if new is not None:
                return a, e, new
        return None

    def value(self, kind: str, text: str, a: int, b: int) -> tuple[int, int, str] | None:
        """As ``valid``; a number that validates only with the head of an issued card behind it leaves the card whole."""
        found = self.valid(kind, text, a, b)
        if found and kind == "card":
            e = found[1]
            digits = re.sub(r"\D", "", text[a:e])
            least = len(digits) + 1 if ISSUED.fullmatch(digits) else 13
            for s in range(a + 1, e):
                if not text[s - 1].isdigit() and (m := CARD.match(text, s)) and m.end() > e:
                    other = self.valid(kind, text, s, m.end())
                    if other and other[1] > e:
                        digits = re.sub(r"\D", "", text[s:other[1]])
                        if len(digits) >= least and ISSUED.fullmatch(digits):
                            return other
        return found

    def mask(self, text: str) -> tuple[str, list[str]]:
        if not _MAY.search(text):
            return text, []
        kinds: list[str] = []
        out, at, pos = [], 0, 0
        while (m := PATTERN.search(text, pos)) is not None:
            kind = "secret" if m.group("secret") is not None else m.lastgroup
            a, b = m.span("value" if kind == "secret" else kind)
            found = self.value(kind, text, a, b)
            if found is None:
                # Not valid as this kind: look on behind its first run of letters or digits.
                pos = a + len(re.match(r"\W*\w*", text[a:b]).group()) or a + 1
                pos = max(pos, a + 1)
                continue
            start, (a, b, new) = m.start(), found
            out += [text[at:a], new]
            kinds.append(kind)
            at = pos = b
            # A value that began before an email's local part and ended in it: the rest is the local part.
            if (m := EMAIL.match(text, b)) if not _LOCALS.fullmatch(text, start, b) else None:
                out.append(self.pseudonym("email", m.group()))
                kinds.append("email")
                at = pos = m.end()
        return ("".join([*out, text[at:]]), kinds) if kinds else (text, [])


def masker(key: bytes) -> Masker:
    held = worker_cache("pseudonyms")
    if key not in held:
        held[key] = Masker(key)
    return held[key]


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", out: str = "masked") -> DataFrame:
    """All rows with the struct column ``out`` (see RESULT)."""

    @F.pandas_udf(RESULT)
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            rows = [masker(key).mask(x) if isinstance(x, str) else (None, []) for x in column.tolist()]
            yield pd.DataFrame({"text": pd.Series([t for t, _ in rows], dtype=object),
                                "n_found": pd.Series([len(k) for _, k in rows], dtype="int32"),
                                "kinds": pd.Series([sorted(set(k)) for _, k in rows], dtype=object)})

    return docs.withColumn(out, masked(F.col(text_col).cast("string")))
