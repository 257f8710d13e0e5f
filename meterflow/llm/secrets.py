"""Secrets in texts: fixed forms, and strings whose characters look random.

Fixed forms are assignments to a telling name, access keys and long hex runs. Beside them a window
slides over every candidate string; the Shannon entropy of the window is kept up to date by
counts of the characters that enter and leave, and is held against the threshold of the window's
character class: hex, letters and digits of both cases, letters of one case and digits, or letters
alone. The class is taken of the whole candidate and of its parts between signs without those that
look like words or numbers. Candidates on the allow-list are not secrets.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from meterflow.llm.shared import map_texts

# Fixed patterns of the base kinds, in their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
NAMES = re.compile(r"password|passwd|secret|token|api", re.ASCII | re.IGNORECASE)
UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
# Never secrets: identifiers that only look random, numbers joined by signs, repeated fillers.
ALLOWED = (UUID, r"[0-9]+(?:[-_/+=][0-9]*)*", r"(.)\1*")
SIGNS = re.compile(r"[-_/+=]+")
SHORTEST = 20
# Words in one case, with a capital, or joined by capitals.
CASED = re.compile(r"[a-z]+|[A-Z]+|(?:[A-Z]?[a-z]{2,}|[A-Z]+[a-z]{2,})+[A-Z]*")
CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{5}", re.IGNORECASE)
SWITCH = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")


def like_word(part: str) -> bool:
    """Letters alone, cased as words are; long ones also without long runs of consonants."""
    return bool(CASED.fullmatch(part)) and (len(part) < SHORTEST or not CONSONANTS.search(part))


def core(text: str) -> str:
    """The parts of a candidate that are neither words nor numbers nor identifiers, put together."""
    return "".join(part for part in SIGNS.split(re.sub(UUID, "-", text))
                   if not part.isdigit() and not like_word(part))


def class_of(text: str) -> str | None:
    """``hex``, ``mixed``, ``alnum``, ``letters`` or none: the class whose threshold holds."""
    digits = any("0" <= c <= "9" for c in text)
    if not digits:
        return "letters" if text.isalpha() else None
    if all(c in "0123456789abcdef" for c in text) or all(c in "0123456789ABCDEF" for c in text):
        return "hex" if any(c > "9" for c in text) else None
    lower, upper = any("a" <= c <= "z" for c in text), any("A" <= c <= "Z" for c in text)
    if lower and upper:
        return "mixed"
    # Words with a number at an end or between them change seldom.
    return "alnum" if (lower or upper) and len(SWITCH.findall(text)) >= 3 else None


def peak_entropy(text: str, window: int) -> float:
    """The highest entropy, in bits per character, of any window of a string.

    Sum of n log n over the character counts changes by two terms per step, so a step costs
    O(1) whatever the window.
    """
    window = min(window, len(text))
    if not window:
        return 0.0
    term = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0

    def change(char: str, by: int) -> float:
        old = counts.get(char, 0)
        counts[char] = old + by
        return term[old + by] - term[old]

    for char in text[:window]:
        total += change(char, 1)
    least = total
    for leaving, entering in zip(text, text[window:]):
        total += change(leaving, -1)
        total += change(entering, 1)
        least = min(least, total)
    return math.log2(window) - least / window


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {"assign": [], "access": [], "hex": []}
    if NAMES.search(text):
        found["assign"] = [m.span() for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found["access"] = [m.span() for m in ACCESS.finditer(text)]
    found["hex"] = [m.span() for m in HEX.finditer(text)]
    return found


def entropy_spans(
    text: str, window: int = 20, hex_bits: float = 3.0, mixed_bits: float = 3.5,
    alnum_bits: float = 3.5, letters_bits: float = 3.75,
    allowed: Iterable[str] = ALLOWED,
) -> list[tuple[int, int]]:
    """Candidate strings one of whose windows reaches the threshold of its class."""
    fine = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None
    limits = {"hex": hex_bits, "mixed": mixed_bits, "alnum": alnum_bits, "letters": letters_bits}

    def random(string: str) -> bool:
        kind = class_of(string.strip("+/_=-"))
        # A whole candidate is judged as it stands where its class allows for signs.
        if kind in ("hex", "mixed") and peak_entropy(string, window) >= limits[kind]:
            return True
        rest = core(string)
        kind = class_of(rest) if len(rest) >= SHORTEST else None
        return kind is not None and peak_entropy(rest, window) >= limits[kind]

    return [m.span() for m in CANDIDATE.finditer(text)
            if not (fine and fine.fullmatch(m.group())) and random(m.group())]


def listed(found: dict[str, list[tuple[int, int]]]) -> str:
    """``kind:start:end`` by start, then kind in its fixed order."""
    spans = sorted(
        (start, KINDS.index(kind), end) for kind, each in found.items() for start, end in each)
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, keep: list[str] | None = None, **thresholds) -> DataFrame:
    """One row per document with its secrets; offsets count code points, ends are exclusive.

    A null or empty text has no spans. Repeated rows are judged each for themselves; other columns
    are dropped unless named in ``keep``.
    """

    def of_batch(texts: list[bytes]):
        for data in texts:
            text = data.decode("utf-8", "replace")
            found = base_spans(text)
            base = listed(found)
            more = entropy_spans(text, **thresholds)
            yield (
                len(found["assign"]), len(found["access"]), len(found["hex"]), len(more),
                hashlib.sha256(base.encode()).hexdigest(), listed(found | {"entropy": more}))

    return map_texts(
        docs, keep or ["doc_id"],
        "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, "
        "spans string", of_batch)
