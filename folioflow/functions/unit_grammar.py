"""Numbers and unit strings: segmentation of a unit by dynamic programming over tries.

A unit string is cut into a prefix (scale), a root (currency, ratio, count or duration), an exponent (power of ten)
and fillers, each with a trie of its own. Several cuts may be possible, as for ``m`` (million or month) or ``mm``; the cheapest wins, where a root
costs less the likelier its dimension is in the field it stands in. These likelihoods come from the table (``operators.units``); without them the words of the field's
name give them."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache
from typing import NamedTuple

MONEY, RATIO, COUNT, DURATION = "money", "ratio", "count", "duration"

# Scales and units as they are written in financial documents.
PREFIXES = {
    3: ["k", "thousand", "thousands", "tsd", "tsd.", "'000", "'000s", "000s", "000"],
    6: ["m", "mm", "mn", "mn.", "mln", "mio", "mio.", "million", "millions"],
    9: ["b", "bn", "bn.", "bln", "mrd", "mrd.", "md", "milliard", "milliards", "billion", "billions"],
    12: ["t", "tn", "tn.", "trn", "trillion", "trillions"],
}
ROOTS = {
    ("CAD", MONEY, "1"): ["cad", "c$", "ca$", "cdn$", "$", "dollar", "dollars", "canadian dollar", "canadian dollars"],
    ("USD", MONEY, "1"): ["usd", "us$", "u.s.$", "us dollar", "us dollars", "u.s. dollar", "u.s. dollars"],
    ("EUR", MONEY, "1"): ["eur", "€", "euro", "euros"],
    ("GBP", MONEY, "1"): ["gbp", "£", "pound", "pounds", "pound sterling", "pounds sterling", "sterling"],
    ("ppm", RATIO, "10000"): ["%", "percent", "per cent", "pct", "pct.", "percentage point", "percentage points", "pp", "p.p.", "pps", "ppt"],
    ("ppm", RATIO, "100"): ["bp", "bp.", "bps", "bps.", "basis point", "basis points"],
    ("ppm", RATIO, "1000"): ["‰", "per mille", "permille", "per mil"],
    ("ppm", RATIO, "1000000"): ["fraction", "decimal", "decimal fraction"],
    ("ppm", RATIO, "1"): ["ppm", "parts per million"],
    ("each", COUNT, "1"): [
        "#", "unit", "units", "user", "users", "client", "clients", "customer", "customers", "device", "devices", "terminal", "terminals",
        "machine", "machines", "employee", "employees", "fte", "ftes", "account", "accounts", "branch", "branches", "item", "items", "each",
    ],
    ("month", DURATION, "1"): ["month", "months", "mth", "mths", "mths.", "mo", "mos", "mos.", "m"],
    ("month", DURATION, "3"): ["quarter", "quarters", "qtr", "qtrs"],
    ("month", DURATION, "12"): ["year", "years", "yr", "yrs", "yr.", "yrs.", "y"],
}
EXPONENTS = {3: ["10^3", "e3", "10³"], 6: ["10^6", "e6", "10⁶"], 9: ["10^9", "e9", "10⁹"]}
FILLERS = ["in", "of", "as", "a", "an", "the", "per", " ", ",", ".", ":", ";", "/", "×", "x", "-", "–", "(", ")", "[", "]", "~"]
DIMENSIONS = (MONEY, RATIO, COUNT, DURATION)
UNKNOWN = (0.25, 0.25, 0.25, 0.25)
#: Words that suggest a dimension where the table says nothing of a field.
DIMENSION_WORDS = {
    RATIO: ["ratio", "margin", "return", "rate", "yield"],
    DURATION: ["term", "maturity", "duration", "gap", "period", "tenor"],
    COUNT: ["clients", "customers", "employees", "accounts", "branches", "users", "headcount"],
    MONEY: ["assets", "deposits", "income", "revenue", "expenses", "costs", "losses", "capital", "loans"],
}
Prior = tuple[float, float, float, float]


class Unit(NamedTuple):
    """Power of ten of the scale, or None; root (common unit, dimension, factor), or None."""

    scale: int | None
    root: tuple[str, str, str] | None


def _trie(words: list[tuple[str, str, object]]) -> dict:
    top: dict = {}
    for word, kind, value in words:
        node = top
        for ch in word:
            node = node.setdefault(ch, {})
        node.setdefault("", []).append((kind, value))
    return top


TRIES = (
    _trie([(w, "scale", s) for s, words in PREFIXES.items() for w in words]),
    _trie([(w, "root", r) for r, words in ROOTS.items() for w in words]),
    _trie([(w, "scale", s) for s, words in EXPONENTS.items() for w in words]),
    _trie([(w, "filler", None) for w in FILLERS]),
)


def field_dimension(metric_name: str | None) -> str | None:
    """The dimension the name of a metric suggests: that of the word that stands last in it."""
    name, best = (metric_name or "").casefold(), (-1, 0, None)
    for dimension, words in DIMENSION_WORDS.items():
        for word in words:
            at = name.rfind(word)
            if at >= 0:
                best = max(best, (at + len(word), len(word), dimension), key=lambda b: b[:2])
    return best[2]


def prior_of(dimension: str | None) -> Prior:
    return UNKNOWN if dimension is None else tuple(0.94 if d == dimension else 0.02 for d in DIMENSIONS)


def learned_prior(name: str | None, counts: Iterable[int]) -> Prior:
    """The likelihood of each dimension in a field, from how often each was stated in it and, as two more statements, from its name."""
    counts, words = list(counts), prior_of(field_dimension(name))
    return tuple(round((n + 2 * w) / (sum(counts) + 2), 2) for n, w in zip(counts, words, strict=True))


def _surprise(p: float) -> float:
    return -0.75 * math.log(max(p, 0.01))


def _cost(kind: str, value, length: int, prior: Prior) -> float:
    if kind == "filler":
        return 0.3 + 0.05 * length
    cost = 1.0 + (1.0 if length == 1 else 0.0)
    if kind == "root":
        return cost + _surprise(prior[DIMENSIONS.index(value[1])])
    return cost + _surprise(prior[0] + prior[2])  # amounts and counts have scales


def segment(text: str, field: str | Prior | None) -> Unit | None:
    """The cheapest cut of the whole of ``text``, with at most one scale and one root; None if there is none. ``field``: the likelihoods of
    the dimensions, or the only likely one.

    Letters that stand side by side may only be cut between a currency and its scale, as in ``CADbn``."""
    return _segment(text, field if isinstance(field, tuple) else prior_of(field))


@lru_cache(maxsize=200_000)
def _segment(text: str, prior: Prior) -> Unit | None:
    text = text.casefold().replace("’", "'").strip()
    best: list[dict[tuple, tuple[float, Unit, str]]] = [{} for _ in range(len(text) + 1)]
    best[0][(None, None, "")] = (0.0, Unit(None, None), "")
    for i in range(len(text)):
        if not best[i]:
            continue
        for trie in TRIES:
            node, j = trie, i
            while j < len(text) and text[j] in node:
                node, j = node[text[j]], j + 1
                for kind, value in node.get("", ()):
                    glued_right = text[j - 1].isalpha() and j < len(text) and text[j].isalpha()
                    for cost, unit, last in list(best[i].values()):
                        glued = i > 0 and text[i - 1].isalpha() and text[i].isalpha()
                        if (glued or glued_right) and kind == "filler":
                            continue
                        if glued and not ({kind, last} == {"scale", "root"}):
                            continue
                        if kind == "scale":
                            if unit.scale is not None:
                                continue
                            new = Unit(value, unit.root)
                        elif kind == "root":
                            if unit.root is not None:
                                continue
                            new = Unit(unit.scale, value)
                        else:
                            new = unit
                        total, key = cost + _cost(kind, value, j - i, prior), (new.scale, new.root, kind)
                        if key not in best[j] or total < best[j][key][0]:
                            best[j][key] = (total, new, kind)
    ends = [(c, u) for c, u, _ in best[len(text)].values() if (u.scale is None or u.root is None or u.root[1] in (MONEY, COUNT))]
    return min(ends, key=lambda e: e[0])[1] if ends else None


def stated_dimension(unit: str | None) -> str | None:
    """The dimension that a unit states whatever the field it stands in; None if it states none or several are possible."""
    text = unicodedata.normalize("NFKC", unit or "").strip()
    found = {u.root[1] if u is not None and u.root is not None else None for u in (segment(text, d) for d in DIMENSIONS)} if text else {None}
    return found.pop() if len(found) == 1 else None


NUMBER = re.compile(r"\d+(?:[.,'’    ]\d+)*")
_MINUS = "-−–—‒﹣－"
APPROXIMATE = re.compile(r"(?i)(?<![a-z])(?:approximately|approx\.?|around|about|circa|ca\.|c\.)|[~≈±+]")
CHANGE = re.compile(rf"(?i)\(\s*(?:[+{_MINUS}]|up\b|down\b|unch)[^()]*\)\s*$")


def parse_number(text: str) -> Decimal | None:
    """A number in any of the usual styles; None if the groups of digits fit none.

    A comma followed by three digits groups thousands, any other single comma is a decimal one; a single point is a decimal one."""
    text = re.sub(r"(?<=\d)['’    ](?=\d)", "_", text)
    if "_" in text:
        whole, *rest = re.split(r"[.,](?=\d+$)", text) if re.search(r"_\d{3}[.,]\d+$", text) else [text]
        if not re.fullmatch(r"\d{1,3}(?:_\d{3})+", whole):
            return None
        return Decimal(whole.replace("_", "") + ("." + rest[0] if rest else ""))
    marks = re.sub(r"\d", "", text)
    if not marks:
        return Decimal(text)
    if len(set(marks)) == 2:
        last = marks[-1]
        if marks.count(last) > 1:
            return None
        whole, _, part = text.rpartition(last)
        return Decimal(re.sub("[.,]", "", whole) + "." + part) if re.fullmatch(r"\d{1,3}(?:[.,]\d{3})+", whole) else None
    if len(marks) > 1 or (marks == "," and re.fullmatch(r"[1-9]\d{0,2},\d{3}", text)):
        return Decimal(re.sub("[.,]", "", text)) if re.fullmatch(r"\d{1,3}(?:[.,]\d{3})+", text) else None
    return Decimal(text.replace(",", "."))


@lru_cache(maxsize=200_000)
def parse_value(text: str) -> tuple[Decimal, str] | None:
    """The one number of a metric value, signed, and the text around it; None for ranges, words and several numbers."""
    text = unicodedata.normalize("NFKC", text).strip()
    text = CHANGE.sub("", text) if NUMBER.search(CHANGE.sub("", text)) else text
    text = re.sub(r"(?<![\d.,])['’]000s?\b|(?<![\d.,'’  ])\b000s?\b", " thousand ", text)
    found = list(NUMBER.finditer(text))
    if len(found) != 1:
        return None
    number = parse_number(found[0].group())
    if number is None:
        return None
    before, after = text[: found[0].start()], text[found[0].end() :]
    negative = False
    if before.rstrip().endswith("(") and ")" in after:
        negative, before, after = True, before.rstrip()[:-1], after.replace(")", "", 1)
    before = APPROXIMATE.sub(" ", before)
    if re.search(rf"[{_MINUS}]\s*$", before):
        negative, before = True, re.sub(rf"[{_MINUS}]\s*$", "", before)
    elif re.match(rf"\s*[{_MINUS}]", before):
        negative, before = True, re.sub(rf"^\s*[{_MINUS}]", "", before)
    return (-number if negative else number), f"{before.strip()} {after.strip()}".strip()


CUE = re.compile(
    r"(?i)(?:\bunits?\s*:|\b(?:figures|amounts|values|numbers|all)\s+(?:are\s+)?(?:given\s+|stated\s+|expressed\s+|shown\s+)?in\b|\bcolumn header\s*:|\ball values\b|\bexpressed in\b|\bstated in\b)\s*(.+)$"
)
TAIL = re.compile(r"(?:[,–—]\s+|\s-\s+)(?P<plain>.+)$|[(\[](?P<inner>[^()\[\]]*)[)\]]\s*$")


def _tails(name: str) -> list[str]:
    """What may be the unit at the end of a metric's name, the longest first."""
    bracket = re.search(r"[(\[]([^()\[\]]*)[)\]]\s*$", name)
    if bracket:
        return [bracket.group(1)]
    return [name[m.end() :] for m in re.finditer(r"[,–—:]\s+|\s-\s+", name)]


#: Most words on either side of a value, and after a cue, that are tried as its unit.
BESIDE = 5


def _unit_prefix(words: list[str], dimension: Prior) -> list[str]:
    """The longest run of first words that states a unit, in a list of its own; empty if there is none."""
    for n in range(min(len(words), BESIDE), 0, -1):
        text = " ".join(words[:n]).rstrip(".,;:)")
        if (u := segment(text, dimension)) is not None and (u.scale is not None or u.root is not None):
            return [text]
    return []


def _beside(text: str, number: Decimal, dimension: Prior) -> list[str]:
    """What states a unit around the first place of the text that gives the number: as many of the words beside it as parse."""
    for found in NUMBER.finditer(text):
        if parse_number(found.group()) != abs(number):
            continue
        before, after = text[: found.start()], text[found.end() :]
        # words of another clause or number are not beside it
        left = re.split(r"[.,;:()](?:\s|$)|\d", before)[-1].split()[-BESIDE:]
        right = re.split(r"[.,;:()](?:\s|$)|\d", after)[0].split()[:BESIDE]
        cuts = sorted(((a, b) for a in range(len(left) + 1) for b in range(len(right) + 1) if a + b), key=lambda c: (-sum(c), c[0]))
        for a, b in cuts:
            span = " ".join([*left[len(left) - a :], *right[:b]])
            if (u := segment(span, dimension)) is not None and (u.scale is not None or u.root is not None):
                return [span]
    return []


def places(
    value_rest: str, unit: str | None, name: str | None, location: str | None, finding: str | None, number: Decimal | None = None, own: str | None = None, prior: Prior | None = None
) -> list[Iterable[str]]:
    """The texts that may state a unit, place by place in the order in which they prevail. ``own``: a bracket that belongs to the metric's name."""
    likely = prior_of(field_dimension(name)) if prior is None else prior

    def clean(text: str | None) -> str:
        return unicodedata.normalize("NFKC", text or "").strip()

    def cued(text: str | None) -> Iterator[str]:
        found = CUE.search(clean(text))
        if found:
            yield found.group(1).strip().removesuffix(")").strip().removesuffix(".")
            yield found.group(1).strip().removesuffix(")")
            # more text follows the unit
            yield from _unit_prefix(found.group(1).split(), likely)
        if number is not None:
            yield from _beside(clean(text), number, likely)

    return [[value_rest], [clean(unit)], _tails(clean(name).replace(own, "", 1).strip() if own else clean(name)), cued(location), cued(finding)]


def common_amount(
    value: str | None, unit: str | None, name: str | None, location: str | None, finding: str | None, own: str | None = None, prior: Prior | None = None
) -> tuple[str, int] | None:
    """(common unit, amount) of a finding, or None if its value is not one number with a known unit.

    ``own`` and ``prior`` are what the table tells of the metric. Amounts are rounded half up to whole units; one beyond 64 bits is no case."""
    parsed = parse_value(value) if value else None
    if parsed is None:
        return None
    number, rest = parsed
    likely = prior_of(field_dimension(name)) if prior is None else prior
    scale = root = None
    for at, texts in enumerate(places(rest, unit, name, location, finding, number, own, likely)):
        read = next((u for t in texts if t and (u := segment(t, likely)) is not None), None)
        if read is None:
            if at == 0 and rest:
                return None  # words beside the number
            continue
        scale = read.scale if scale is None else scale
        root = read.root if root is None else root
        if root is not None and (scale is not None or root[1] not in (MONEY, COUNT)):
            break  # later places state nothing that counts
    if root is None:
        if scale is None or likely[DIMENSIONS.index(COUNT)] <= 0.5:
            return None
        root = ("each", COUNT, "1")
    factor = Decimal(root[2]) * (Decimal(10) ** scale if scale is not None and root[1] in (MONEY, COUNT) else 1)
    amount = int((number * factor).quantize(Decimal(1), rounding=ROUND_HALF_UP))
    return (root[0], amount) if abs(amount) < 2**63 else None
