"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Validated numbers, dates, addresses and secrets are permuted among the values of their own
format: a card number stays a card number with a right check digit, a date stays a date. The same
value has the same pseudonym in every document and layout, and no table of values is kept.
"""

from __future__ import annotations

import datetime
import ipaddress
import re
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, functions as F

KINDS = ("email", "secret", "iban", "ip", "date", "card", "ssn", "phone")
ROUNDS = 8
#: Characters of a string that are permuted together.
WIDE = 64
_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: What stands before the value of a secret, in any case, with or without blanks and quotes.
_NAMES = r"(?:pass(?:word|wd|phrase)|pwd|token|(?:api|access|auth|secret|private|encryption)[_-]?key|client[_-]secret|secret|credentials?)"
_KEYWORD = rf"""(?i:{_NAMES})["']?[ \t]*[=:][ \t]*["']?"""
_EMAIL = r"[\w.%+-]+@[\w-]+\.[\w]"

# Month names in the four languages of the corpus, shortened English ones, and country calling
# codes of one and two digits; all other codes have three.
_MONTHS = {
    "en": "January February March April May June July August September October November December",
    "short": "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec",
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}
_MONTHS = {language: names.split() for language, names in _MONTHS.items()}
_CODES = {"1", "7"} | set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
_MONTH = "|".join(sorted({n for names in _MONTHS.values() for n in names}, key=lambda n: (-len(n), n)))

# The written forms that are looked for. Order decides where two start at one place.
FORMS = {
    "email": r"(?<![\w.+%-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)+",
    "secret": r"(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])"
    r"|-----BEGIN (?P<key>[A-Z ]*PRIVATE KEY)-----(?P<block>(?:[^-]|-(?!----))+)-----END (?P=key)-----"
    r"|(?<![A-Za-z])(?i:bearer)[ \t]+(?P<bearer>[\w.~+/-]{16,}=*)"
    r"|(?<![\w-])(?P<jwt>eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,})"
    rf"""|(?i:{_NAMES})["']?[ \t]*[=:][ \t]*(?P<mark>["'])(?!{_EMAIL})(?P<quoted>[^"'\s]{{4,}})(?P=mark)"""
    rf"""|{_KEYWORD}(?!{_KEYWORD}|{_EMAIL})(?P<value>[\w+/-]{{8,}}(?:[^\s"'<>,;(){{}}\[\]]*[\w+/=-])?|(?=[^\s"'<>,;]*[\W_])(?=[^\s"'<>,;]*[0-9])[^\s"'<>,;()]{{7,}}[\w+/=-])"""
    r"|(?<![0-9A-Za-z])(?=[a-fA-F]*[0-9])(?=[0-9]*[a-fA-F])[0-9a-fA-F]{32,}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[\w])|(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])[0-9A-Fa-f]{1,4}:(?:[0-9A-Fa-f]{0,4}:){1,6}[0-9A-Fa-f]{0,4}(?![\w:])",
    "date": rf"(?<![\w./-])(?:(?:{_MONTH})\.? [0-9]{{1,2}}(?:st|nd|rd|th)?,? [0-9]{{4}}|[0-9]{{1,2}}(?:\.|st|nd|rd|th)? (?:de )?(?:{_MONTH})\.?,? (?:de )?[0-9]{{4}})(?![\w-])"
    r"|(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?!(?![Tt](?:[01][0-9]|2[0-4]))[\w/-]|\.[0-9])",
    "card": r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]|\.[0-9])",
    "ssn": r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]|\.[0-9])",
    "phone": r"(?<![\w.+-])\+[1-9](?:[ .-]?\(?[0-9]\)?){6,14}(?![\w-]|\.[0-9])"
    r"|(?<![\w.+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![\w-]|\.[0-9])",
}
_FIND = re.compile("|".join(f"(?P<{kind}>{FORMS[kind]})" for kind in KINDS))
_ONE = {kind: re.compile(form) for kind, form in FORMS.items()}
#: Forms that take further groups of digits or letters after a blank or hyphen: a shorter value may end before each.
_GROUPED = {"iban": re.compile("(?= )"), "card": re.compile("(?=[ -])")}
_MAYBE = re.compile(r"[0-9@]|AKIA|eyJ|PRIVATE KEY|(?i:pass|pwd|token|key|secret|credential|bearer)")
#: Small letters of the corpus's languages beyond ASCII, a class of their own.
_ACCENTED = "àáâäæçèéêëíîïñóôöœùúûüÿß"
_WRITTEN = re.compile(rf"(?P<day>[0-9]{{1,2}})(?![0-9])|(?P<month>{_MONTH})|(?P<year>[0-9]{{4}})")


class Pseudonyms:
    """Keyed permutations. ``replace`` gives the pseudonyms of a text; texts without personal data stay as they are."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, n: int, number: int, half: int) -> int:
        data = b"%d|%d|" % (n, number) + half.to_bytes((half.bit_length() + 8) // 8, "big")
        return int.from_bytes(blake2b(data, key=self.key, person=kind.encode()).digest(), "big")

    def permute(self, kind: str, value: int, n: int) -> int:
        """A permutation of 0..n-1: unbalanced Feistel rounds on a grid of at least n cells, walked until inside."""
        wide = isqrt(n - 1) + 1 if n > 1 else 1
        tall = -(-n // wide)
        while True:
            left, right = divmod(value, wide)
            for r in range(0, ROUNDS, 2):
                left = (left + self._round(kind, n, r, right)) % tall
                right = (right + self._round(kind, n, r + 1, left)) % wide
            value = left * wide + right
            if value < n:
                return value

    def characters(self, kind: str, text: str) -> str:
        """Digits and letters permuted within their classes, other characters kept."""
        if len(text) > WIDE:
            return "".join(self.characters(kind, text[i : i + WIDE]) for i in range(0, len(text), WIDE))
        hexadecimal = kind == "secret" and re.fullmatch("[0-9a-f]{16,}", text)
        classes = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _ACCENTED)
        sets = ["0123456789abcdef" if hexadecimal else next((s for s in classes if c in s), c) for c in text]
        value, n = 0, 1
        for c, s in zip(text, sets):
            value, n = value * len(s) + s.index(c), n * len(s)
        value, out = self.permute(kind, value, n), []
        for s in reversed(sets):
            value, at = divmod(value, len(s))
            out.append(s[at])
        return "".join(reversed(out))

    def _email(self, text: str) -> str:
        name, _, host = text.partition("@")
        return self.characters("email", name) + "@" + host

    def _secret(self, text: str) -> str:
        if re.fullmatch("[0-9A-F]{16,}", text) and not text.isdigit():  # the same pseudonym as in small letters
            return self.characters("secret", text.lower()).upper()
        head = "AKIA" if text.startswith("AKIA") and len(text) == 20 else ""
        return head + self.characters("secret", text[len(head) :])

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
            return None
        account = self.characters("iban" + plain[:2], plain[4:])
        return _laid(text, f"{plain[:2]}{98 - number(account + plain[:2] + '00') % 97:02d}{account}")

    def _ip(self, text: str) -> str | None:
        if ":" in text:
            try:
                address = ipaddress.IPv6Address(text)
            except ValueError:
                return None
            if address.is_loopback or address.is_unspecified:
                return None
            new = ipaddress.IPv6Address(self.permute("ip6", int(address), 1 << 128))
            return str(new).upper() if text.isupper() else str(new)
        parts = text.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        return str(ipaddress.IPv4Address(self.permute("ip", int(ipaddress.IPv4Address(text)), 1 << 32)))

    def _written(self, text: str) -> str | None:
        """A date with the name of its month; the new one has a name of the same language, or of the first that fits."""
        found = {m.lastgroup: m for m in _WRITTEN.finditer(text)}
        if set(found) != {"day", "month", "year"}:
            return None
        names = next(names for names in _MONTHS.values() if found["month"][0] in names)
        try:
            day = datetime.date(int(found["year"][0]), names.index(found["month"][0]) + 1, int(found["day"][0])).toordinal()
        except ValueError:
            return None
        if not _FIRST <= day <= _LAST:
            return None
        new = datetime.date.fromordinal(_FIRST + self.permute("date", day - _FIRST, _LAST - _FIRST + 1))
        parts = {"day": str(new.day), "month": names[new.month - 1], "year": f"{new.year:04d}"}
        out, done = [], 0
        for m in sorted(found.values(), key=lambda m: m.start()):
            out += [text[done : m.start()], parts[m.lastgroup]]
            done = m.end()
        return "".join([*out, text[done:]])

    def _date(self, text: str) -> str | None:
        if any(c.isalpha() for c in text):
            return self._written(text)
        for form in ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y"):
            try:
                day = datetime.datetime.strptime(text, form).date().toordinal()
            except ValueError:
                continue
            if not _FIRST <= day <= _LAST:
                return None
            return datetime.date.fromordinal(_FIRST + self.permute("date", day - _FIRST, _LAST - _FIRST + 1)).strftime(form)
        return None

    def _card(self, text: str) -> str | None:
        plain = re.sub("[ -]", "", text)
        if not 13 <= len(plain) <= 19 or _luhn(plain[:-1]) != plain[-1] or len(set(plain)) == 1:
            return None
        payload = self.characters("card", plain[:-1])
        return _laid(text, payload + _luhn(payload))

    def _ssn(self, text: str) -> str | None:
        area, group, serial = (int(p) for p in text.split("-"))
        areas = 899 - 1  # 1 to 899 without 666
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self.permute("ssn", value, areas * 99 * 9999), 9999)
        area, group = divmod(value, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _phone(self, text: str) -> str | None:
        digits = re.sub("[^0-9]", "", text)
        kept = max(0, len(digits) - 10)
        if text.startswith("+"):
            kept = next((n for n in (1, 2) if digits[:n] in _CODES), 3)
            if not 7 <= len(digits) - kept <= 15 - kept:
                return None
        return _laid(text, digits[:kept] + self.characters("phone", digits[kept:]))

    def _value(self, text: str, start: int, first: str) -> tuple[str, int, int, str] | None:
        """(kind, start, end, pseudonym) of the value whose form starts at ``start``; None if no kind's check holds.

        Kinds are tried from ``first`` on. If the check fails for all that a grouped form takes, what
        ends before one of its last groups is tried, longest first.
        """
        for kind in KINDS[KINDS.index(first) :]:
            m = _ONE[kind].match(text, start)
            if not m:
                continue
            named = [g for g in ("value", "quoted", "bearer", "jwt", "block") if m[g]] if kind == "secret" else []
            begin, last = m.span(named[0] if named else 0)
            cuts = [c.start() for c in _GROUPED[kind].finditer(text, begin, last)] if kind in _GROUPED else []
            for end in [last, *reversed(cuts)]:
                new = getattr(self, f"_{kind}")(text[begin:end])
                if new is not None:
                    return kind, begin, end, new
        return None

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, length) of what was replaced in it."""
        found: list[tuple[str, int, int]] = []
        if not _MAYBE.search(text):
            return text, found
        out, done, at = [], 0, 0
        while m := _FIND.search(text, at):
            value = self._value(text, m.start(), next(kind for kind in KINDS if m[kind] is not None))
            if value is None:  # the form without the check: other forms may start inside it
                at = m.start() + 1
                continue
            kind, start, end, new = value
            found.append((kind, start, end - start))
            out += [text[done:start], new]
            done = at = end
        return "".join([*out, text[done:]]), found


def _laid(layout: str, characters: str) -> str:
    """Characters in the places that digits and letters have in a layout."""
    new = iter(characters)
    return "".join(next(new) if c.isalnum() else c for c in layout)


def _luhn(payload: str) -> str:
    """The check digit of a card number."""
    twice = [sum(divmod(2 * int(c), 10)) for c in payload[::-2]]
    return str(-(sum(twice) + sum(map(int, payload[-2::-2]))) % 10)


def pseudonymise(text: Column, key: bytes) -> Column:
    """struct(text, found) of a text column: pseudonyms in place, and what was replaced.

    ``found`` lists kind, start and length (in characters of the input), in order. Null gives a
    null text and an empty list; texts without personal data, empty ones among them, come back
    unchanged. What has the form but fails its check (a card number's digit, a day of a month) is
    left alone. Whole texts are searched, whatever their length.
    """
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
    made = Pseudonyms(key)

    def replace(texts: pa.Array) -> pa.Array:
        new, found = [], []
        for value in texts:
            value = value.as_py()
            changed, where = (None, []) if value is None else made.replace(value)
            new.append(changed)
            found.append([{"kind": k, "start": s, "length": n} for k, s, n in where])
        return pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(found, spans)], ["text", "found"])

    return F.arrow_udf(replace, "text string, found array<struct<kind: string, start: int, length: int>>")(text)
