"""Format-preserving pseudonyms for numbers and dates in texts.

Each kind is found by its form, validated by its own rule (check digits, ranges, the calendar) and
replaced by a keyed permutation of its format: a Feistel network over its digits, or over its number in
the range of valid values. Equal values get equal pseudonyms in every document, different values
different ones, and whoever has the key can restore them. Separators and lengths stay, and
a pseudonym passes the same validation as its original.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame

from meterflow.llm.shared import map_texts

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutations of whole ranges and of texts over an alphabet."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, number: int, modulus: int, half: int) -> int:
        said = f"{kind}:{number}:{modulus}:{half}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=32).digest(), "big")

    def _pair(self, kind: str, left: int, right: int, a: int, b: int, back: bool) -> tuple[int, int]:
        """Alternating rounds over two halves with moduli ``a`` and ``b``."""
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if number % 2 == 0:
                left = (left + sign * self._round(kind, number, a, right)) % a
            else:
                right = (right + sign * self._round(kind, number, b, left)) % b
        return left, right

    def number(self, kind: str, value: int, size: int, back: bool = False) -> int:
        """A permutation of 0..size-1: a square that holds the range is walked until it is met."""
        if size < 2:
            return value
        b = int(size ** 0.5) + 1
        a = -(-size // b)
        while True:
            left, right = self._pair(kind, value // b, value % b, a, b, back)
            value = left * b + right
            if value < size:
                return value

    def text(self, kind: str, value: str, alphabet: str, back: bool = False) -> str:
        """A permutation of the texts of one length over an alphabet."""
        radix, places = len(alphabet), {c: n for n, c in enumerate(alphabet)}
        number = 0
        for char in value:
            number = number * radix + places[char]
        half = len(value) // 2
        low = radix ** (len(value) - half)
        if half:
            left, right = self._pair(
                f"{kind}/{len(value)}", number // low, number % low, radix ** half, low, back)
            number = left * low + right
        else:
            number = self.number(f"{kind}/{len(value)}", number, radix, back)
        out = []
        for _ in value:
            number, digit = divmod(number, radix)
            out.append(alphabet[digit])
        return "".join(reversed(out))


DIGITS = "0123456789"
Permute = Callable[[Feistel, str, bool], str | None]


def _into(form: str, digits: str) -> str:
    """Digits put in the places that digits have in ``form``."""
    following = iter(digits)
    return "".join(next(following) if c in DIGITS else c for c in form)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def luhn_digit(body: str) -> str:
    total = 0
    for place, char in enumerate(reversed(body)):
        value = int(char) * (2 if place % 2 == 0 else 1)
        total += value - 9 if value > 9 else value
    return str(-total % 10)


def card(feistel: Feistel, text: str, back: bool) -> str | None:
    """13 to 19 digits with a Luhn check digit; the leading digit, which names the network, stays."""
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    body = digits[0] + feistel.text(f"card{digits[0]}", digits[1:-1], DIGITS, back)
    # All zeros is no valid card and cannot come out: its own image is walked past.
    while not body.strip("0"):
        body = digits[0] + feistel.text(f"card{digits[0]}", body[1:], DIGITS, back)
    return _into(text, body + luhn_digit(body))


# Length of an IBAN by country.
IBAN_LENGTHS = {code: int(length) for length, codes in (
    part.split(":") for part in (
        "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,CR,HR,LI,LV "
        "22:BG,BH,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG "
        "25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV "
        "29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split())
    for code in codes.split(",")}


def _iban_valid(plain: str) -> bool:
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _iban_start(text: str) -> str | None:
    """The beginning that is an IBAN by its country's length, if a blank or the end follows it."""
    left = IBAN_LENGTHS.get(text[:2], 0)
    for at, char in enumerate(text):
        left -= char != " "
        if left == 0:
            start = text[: at + 1]
            return start if text[at + 1: at + 2] in ("", " ") and _iban_valid(start.replace(" ", "")) else None
    return None


def iban(feistel: Feistel, text: str, back: bool) -> str | None:
    """The country's length of the text if that is an IBAN, or else the whole text if it is one."""
    if start := _iban_start(text):
        return _iban(feistel, start, back)
    text_or_none = _iban(feistel, text, back)
    # An image that would be cut on the way back is walked past.
    while text_or_none is not None and _iban_start(text_or_none):
        text_or_none = _iban(feistel, text_or_none, back)
    return text_or_none


def _iban(feistel: Feistel, text: str, back: bool) -> str | None:
    """Country, two check digits by modulus 97, and an account whose digits are permuted."""
    plain = text.replace(" ", "")
    if not _iban_valid(plain):
        return None
    account = plain[4:]
    digits = _digits(account)
    if len(digits) < 4:
        return None
    # The letters' places are part of the format.
    account = _into(account, feistel.text(f"iban{plain[:2]}", digits, DIGITS, back))
    check = 98 - int("".join(str(int(c, 36)) for c in account + plain[:2] + "00")) % 97
    following = iter(f"{plain[:2]}{check:02d}{account}")
    return "".join(c if c == " " else next(following) for c in text)


def social(feistel: Feistel, text: str, back: bool) -> str | None:
    """ddd-dd-dddd without the numbers that are never issued."""

    def valid(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    digits = _digits(text)
    if not valid(digits):
        return None
    while True:
        digits = feistel.text("social", digits, DIGITS, back)
        if valid(digits):
            return _into(text, digits)


def phone(feistel: Feistel, text: str, back: bool) -> str | None:
    """``+``, country code and 7 to 12 more digits; the country code stays.

    Groups behind a blank that make the number too long are not part of it; after ``+1`` ten digits
    are enough. Only the form decides, so the way back cuts alike.
    """
    head = re.match(r"\+\d{1,3}", text).group()
    most = 10 if head == "+1" else min(12, 15 - (len(head) - 1))
    while len(_digits(text[len(head):])) > most and " " in text[len(head):]:
        shorter = text[: text.rindex(" ")]
        if len(_digits(shorter[len(head):])) < (10 if head == "+1" else 7):
            break
        text = shorter
    rest = _digits(text[len(head):])
    if not 7 <= len(rest) <= 12 or len(rest) + len(head) - 1 > 15:
        return None
    return head + _into(text[len(head):], feistel.text(f"phone{head}", rest, DIGITS, back))


def address(feistel: Feistel, text: str, back: bool) -> str | None:
    """IPv4: four numbers up to 255 without leading zeros; zero and full addresses stay apart."""
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = feistel.number("ipv4", int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _dated(order: str, least_day: int = 1) -> Permute:
    """Calendar dates from 1900 to 2099 with year, month and day in the given order.

    Dates before ``least_day`` of their month are left, and none of them comes out.
    """

    def permute(feistel: Feistel, text: str, back: bool) -> str | None:
        numbers = dict(zip(order, map(int, re.findall(r"\d+", text))))
        try:
            day = date(numbers["y"], numbers["m"], numbers["d"]).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY or numbers["d"] < least_day:
            return None
        while True:
            day = FIRST_DAY + feistel.number("date", day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, back)
            moved = date.fromordinal(day)
            if moved.day >= least_day:
                break
        parts = {"y": f"{moved.year:04d}", "m": f"{moved.month:02d}", "d": f"{moved.day:02d}"}
        return _into(text, "".join(parts[name] for name in order))

    return permute


def _day_or_month_first(feistel: Feistel, text: str, back: bool) -> str | None:
    """Day, month, year; or with slashes month, day, year where that alone is a date."""
    value = _dated("dmy")(feistel, text, back)
    return value if value is not None or "/" not in text else _dated("mdy", 13)(feistel, text, back)


def mail(feistel: Feistel, text: str, back: bool) -> str | None:
    """Letters and digits before the ``@`` are permuted among their like; the domain stays."""
    local, _, domain = text.rpartition("@")
    for name, alphabet in (
            ("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            ("digit", DIGITS)):
        found = [c for c in local if c in alphabet]
        if found:
            form = "".join("*" if c in alphabet else "-" for c in local)
            following = iter(feistel.text(f"mail/{name}/{form}", "".join(found), alphabet, back))
            local = "".join(next(following) if c in alphabet else c for c in local)
    return f"{local}@{domain}"


# Kinds in the order in which they claim their part of a text. Fixed forms.
KINDS: dict[str, tuple[re.Pattern, Permute]] = {
    "mail": (re.compile(r"(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), mail),
    "iban": (re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)", re.ASCII), iban),
    "date": (re.compile(r"(?<![\d./-])\d{4}-\d{2}-\d{2}(?![\d./-]*\d)", re.ASCII), _dated("ymd")),
    "date_dotted": (re.compile(r"(?<![\d./-])\d{2}([./])\d{2}\1\d{4}(?![\d./-]*\d)", re.ASCII), _day_or_month_first),
    "social": (re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]*\d)", re.ASCII), social),
    "phone": (re.compile(r"(?<![\d+])\+\d{1,3}(?:[ .-]?\(\d+\))?(?:[ .-]?\d+)+(?!\d)", re.ASCII), phone),
    "card": (re.compile(r"(?<![\d.-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\d-]*\d)"
                        r"|(?<![\d.-])\d{4}([ -]?)\d{6}\2\d{5}(?![\d-]*\d)", re.ASCII), card),
    "ipv4": (re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", re.ASCII), address),
}
# Kinds that may end before their match does; what follows is searched again.
CUT = ("iban", "phone")
ANY = re.compile(r"[0-9@]")


def pseudonymised(text: str, feistel: Feistel, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with every valid value permuted, and how many of each kind there were."""
    counts = dict.fromkeys(KINDS, 0)
    if not ANY.search(text):
        return text, counts
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(text))
    for kind, (pattern, permute) in KINDS.items():
        if kind == "mail" and "@" not in text:
            continue
        at = 0
        while match := pattern.search(text, at):
            start, at = match.span()
            # Of a match that runs into an earlier kind's part, the text before that is left.
            given = match.group()
            if kind in CUT and (met := taken.find(1, start, at)) >= 0:
                given = given[: met - start].rstrip(" .-")
                if not pattern.fullmatch(given):
                    continue
            elif any(taken[start:at]):
                continue
            value = permute(feistel, given, back)
            if value is not None:
                end = start + len(value) if kind in CUT else at
                at = end
                taken[start:end] = b"\1" * (end - start)
                found.append((start, end, value))
                counts[kind] += 1
    out, at = [], 0
    for start, end, value in sorted(found):
        out += [text[at:start], value]
        at = end
    return "".join(out) + text[at:], counts


def pseudonymise(
    docs: DataFrame, key: bytes, keep: list[str] | None = None, back: bool = False,
) -> DataFrame:
    """One row per document: the kept columns, ``text`` with pseudonyms, and counts per kind.

    A null text stays null and counts nothing; an empty one stays empty. Repeated rows are treated
    alike. ``back`` restores the originals with the same key.
    """
    kinds = list(KINDS)

    def of_batch(texts: list[bytes]):
        feistel = Feistel(key)
        for data in texts:
            text, counts = pseudonymised(data.decode("utf-8", "replace"), feistel, back)
            yield (text, *[counts[kind] for kind in kinds])

    keep = [name for name in keep or ["doc_id"] if name != "text"]
    made = map_texts(
        docs.withColumn("_null", docs["text"].isNull()), [*keep, "_null"],
        "_made string, " + ", ".join(f"n_{kind} long" for kind in kinds), of_batch)
    return made.selectExpr(
        *[f"`{name}`" for name in keep], "if(_null, null, _made) as text",
        *[f"n_{kind}" for kind in kinds])
