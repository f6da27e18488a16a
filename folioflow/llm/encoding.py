"""Garbled text from a wrong character encoding, found and restored: noisy-channel decoding.

The tokens with other than ASCII characters are a document's observations. Each can have come through a channel: bytes
of one encoding read as another, perhaps twice. A token is a lattice whose edges are its characters; undoing a channel adds an edge for all
bytes that the channel can have made of one character, U+FFFD standing for any byte or letter, so a sequence may be put right or stand. The best path
through a channel's lattice is the token's reading under it. A Viterbi search over the document, lost characters and all, picks the channels: a reading scores by
the frequency of its words in the whole corpus, counted exactly by 64-bit hash, and a change of channel costs, since damage comes in stretches."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOST = "�"
#: Encodings that bytes may have been read in by mistake, and those that they may have been in.
WRONG = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp1254", "cp437", "cp850", "mac_roman")
TRUE_SINGLE = ("cp1252", "mac_roman", "cp850", "cp437", "cp1253", "cp1250")
DEPTH = 3
#: Readings that are kept for each pair of last characters: of a token with lost characters, and of all at one place; of a token without.
PATHS, BEAM, SOUND_PATHS = 64, 2048, 4
#: A lattice with more edges of lost characters than these is not undone again.
EDGES = 5000
#: Different words beside each other, each likelier under one single-byte channel, that count as damage; and by how much one among them may be less likely.
SUPPORTERS, LESS_LIKELY = 3, 0.8
#: A corpus of this many counted words and contexts has its counts as they are; those of others are scaled to it, so that the same frequencies
#: give the same readings at any size. A word rarer than one in so many is read by its letters.
COUNTED = 5_000_000
SWITCH, MULTIBYTE_COST, SINGLE_COST, LEFT_OVER, VALID, MIXED = 4.0, 1.0, 2.0, 3.0, 5.0, 3.0
WILDCARDS = "àâäáãåçèéêëìíîïñòóôõöùúûüßœæøÀÂÄÁÃÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜŒÆØąćęłńśźżĄĆĘŁŃŚŹŻ’‘“”–—…•€£¥°±²³¿¡"


def _byte_of(codec: str) -> dict[str, int]:
    """The byte of each character of an encoding; a byte without a character stands for the code point of its number, as lenient decoders leave it."""
    table = {}
    for b in range(128, 256):
        try:
            table[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            pass
    for b in range(128, 256):
        if b < 160 or b not in table.values():
            table.setdefault(chr(b), b)
    return table


#: The letters and signs that a damaged UTF-8 sequence may stand for, with their bytes, by the number of these.
_SEQUENCES = {
    n: {c: c.encode() for c in dict.fromkeys([*map(chr, [*range(0xA0, 0x180), *range(0x386, 0x3CF), *range(0x400, 0x460)]), *WILDCARDS]) if len(c.encode()) == n}
    for n in (2, 3)
}
_LETTERS = [c for c in dict.fromkeys([*WILDCARDS, *_SEQUENCES[2]]) if c in WILDCARDS or c.isalpha()]
_SIGNS = [c for n in _SEQUENCES for c in _SEQUENCES[n] if c not in _LETTERS]

#: At each place of a token the edges that begin there: their end, and what they say as the token stands and after each channel undone.
Edge = tuple[int, tuple[str, ...]]
Lattice = tuple[tuple[Edge, ...], ...]
_EDGE = re.compile("[\x00-\x7f]+|[^\x00-\x7f]")


def lattice_of(token: str) -> Lattice:
    """A token as it stands: one path, a run of ASCII characters being one edge."""
    return tuple(((k + 1, (said,)),) for k, said in enumerate(_EDGE.findall(token)))


def _is_new(forms: tuple[str, ...]) -> bool:
    """Whether the last channel has made an edge."""
    return len(forms) > 1 and forms[-1] != forms[-2]


def with_letters(lattice: Lattice, known: bool) -> Iterator[list[Edge]]:
    """U+FFFD as any letter; beside a known letter also two or three of them as the lost bytes of one, as of UTF-8 read as ASCII."""
    lost = [next((forms for _, forms in edges if forms[-1] == LOST), None) for edges in lattice]
    for at, edges in enumerate(lattice):
        filled = [(end, (*forms, forms[-1])) for end, forms in edges if forms[-1] != LOST]
        spelled = lost[at]
        for size in (1, 2, 3) if known else (1,):
            if spelled is not None:
                filled += [(at + size, (*spelled, c)) for c in (_SEQUENCES[size] if size > 1 else _LETTERS if known else WILDCARDS)]
                following = lost[at + size] if at + size < len(lattice) else None
                spelled = following and tuple(map(str.__add__, spelled, following))
        yield filled


@lru_cache(maxsize=100_000)
def _characters(data: tuple[int, ...]) -> tuple[str, ...]:
    """The characters that a UTF-8 sequence may stand for; a byte of -1 is lost, and one at least is known."""
    if -1 not in data:
        try:
            text = bytes(data).decode("utf-8")
        except UnicodeDecodeError:
            return ()
        return (text,) if len(text) == 1 else ()
    if max(data) < 0:
        return ()
    return tuple(c for c, known in _SEQUENCES.get(len(data), {}).items() if all(b in (-1, k) for b, k in zip(data, known, strict=True)))


def _length(first: int) -> int:
    """The bytes of a UTF-8 sequence by its first, or the most that are looked at if that is lost."""
    return 3 if first < 0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class MultiByte:
    """UTF-8 read as a single-byte encoding: its valid sequences may be put right, the rest of a token stands."""

    cost = MULTIBYTE_COST

    def __init__(self, wrong: str):
        self.name, self.bytes = f"utf-8>{wrong}", _byte_of(wrong)

        def chars(low: int, high: int) -> str:
            return "[" + "".join(re.escape(c) for c, b in self.bytes.items() if low <= b <= high) + "]"

        more = chars(0x80, 0xBF)
        self.leads = {c for c, b in self.bytes.items() if 0xC2 <= b <= 0xF4}
        self.pattern = re.compile(f"{chars(0xC2, 0xDF)}{more}|{chars(0xE0, 0xEF)}{more}{more}|{chars(0xF0, 0xF4)}{more}{more}{more}")

    def undo(self, token: str) -> str | None:
        changed = self.pattern.sub(self._decode, token)
        return changed if changed != token else None

    def unread(self, lattice: Lattice, wild: bool) -> Lattice | None:
        """The lattice with an edge more for each UTF-8 sequence; if ``wild``, U+FFFD is any byte of one. None if there is none."""
        if not wild and self.leads.isdisjoint(forms[-1] for edges in lattice for _, forms in edges):
            return None
        places, fits = [], False
        for at, edges in enumerate(lattice):
            found = {(end, forms[-1]): (*forms, forms[-1]) for end, forms in edges}
            count = len(found)
            for end, forms in self._sequences(lattice, at, wild):
                found.setdefault((end, forms[-1]), forms)
            fits = fits or len(found) > count
            places.append(tuple((end, forms) for (end, _), forms in found.items()))
        return tuple(places) if fits else None

    def _sequences(self, lattice: Lattice, at: int, wild: bool) -> Iterator[Edge]:
        # what the channel before could put right is not left for this one
        before = {end for end, forms in lattice[at] if _is_new(forms)}
        heads: list[tuple[int, tuple[str, ...], tuple[int, ...], bool]] = [(at, (), (), False)]
        for size in range(1, 5):
            following = []
            for node, spelled, data, new in heads:
                if node < len(lattice) and (not data or size <= _length(data[0])):
                    for end, forms in lattice[node]:
                        b = -1 if wild and forms[-1] == LOST else self.bytes.get(forms[-1], 0)
                        if b < 0 or (0x80 <= b <= 0xBF if data else 0xC2 <= b <= 0xF4):
                            following.append((end, tuple(map(str.__add__, spelled, forms)) if spelled else forms, (*data, b), new or _is_new(forms)))
            heads = following
            if size > 1:
                for end, spelled, data, new in heads:
                    if new or end not in before:
                        yield from ((end, (*spelled, char)) for char in _characters(data))

    def _decode(self, match: re.Match) -> str:
        try:
            return bytes(self.bytes[c] for c in match.group()).decode("utf-8")
        except UnicodeDecodeError:
            return match.group()


class SingleByte:
    """One single-byte encoding read as another: all of a token's characters are turned, or the channel does not fit."""

    cost = SINGLE_COST

    def __init__(self, true: str, wrong: str):
        self.name, self.table = f"{true}>{wrong}", _Turned({p: p for p in [*range(1, 128), ord(LOST)]})
        for char, byte in _byte_of(wrong).items():
            try:
                read = bytes([byte]).decode(true)
            except UnicodeDecodeError:
                continue
            if not "\x80" <= read <= "\x9f":
                self.table[ord(char)] = read

    def undo(self, token: str) -> str | None:
        """The token turned, which may leave it as it is: some characters are the same in both."""
        changed = token.translate(self.table)
        return changed if "\x00" not in changed else None


class _Turned(dict):
    """A translation that marks what has no counterpart with NUL."""

    def __missing__(self, point: int) -> int:
        return 0


@lru_cache(maxsize=1)
def channels() -> tuple[list[MultiByte], list[SingleByte]]:
    return [MultiByte(w) for w in WRONG], [SingleByte(t, w) for t in TRUE_SINGLE for w in WRONG if t != w]


_KEY = re.compile(r"[\x00-@\[-`{-\x7f]+")


# a Latin letter beside a letter of another script or a sign that no word has
_ODD = "[\u0192\u02c6-\u02dd\u0370-\u1fff\u3000-\ud7ff\u2020\u2021\u2030\u2039\u203a\u201a\u201e\u2200-\u22ff\u2310-\u2321\u2500-\u25ff\u00b7\u00b8\u00a8\u00b4\u00ac\ufb01\ufb02]"
_MIXED = re.compile(f"[A-Za-z]{_ODD}|{_ODD}[A-Za-z]")


_first = itemgetter(0)


def token_key(token: str) -> str:
    """A token without ASCII digits and signs, as it is counted."""
    return _KEY.sub("", token)


def contexts(token: str) -> list[str]:
    """Each character beyond ASCII with the letters beside it."""
    padded = f" {_KEY.sub(' ', token)} "
    return [padded[i - 1 : i + 2] for i in range(1, len(padded) - 1) if padded[i] >= "\x80"]


def _hash_of(key: str) -> int:
    """The signed 64-bit hash that a key is counted under: among ten million keys an unseen one meets another's count once in 10^12 times."""
    import xxhash

    h = xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _foreign_tokens(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens with characters beyond ASCII of some texts at once: the joined bytes, where each text begins in them, and
    of each token the text, the first and the end byte. Only ASCII white space parts tokens."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(encoded) + b"\n"
    begins = np.concatenate(([0], np.cumsum([len(e) + 1 for e in encoded]))).astype(np.int64)
    view = np.frombuffer(data, dtype=np.uint8)
    white = np.flatnonzero(view <= 32)
    at = np.unique(np.searchsorted(white, np.flatnonzero(view >= 128)))
    starts = np.where(at > 0, white[np.maximum(at - 1, 0)] + 1, 0)
    ends = white[at]
    return data, begins, np.searchsorted(begins, starts, side="right") - 1, starts, ends


def _pieces(texts: list[str], size: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of some million characters, each with the position of its first."""
    low = 0
    while low < len(texts):
        high, total = low, 0
        while high < len(texts) and (high == low or total + len(texts[high]) <= size):
            total += len(texts[high])
            high += 1
        yield low, texts[low:high]
        low = high


@lru_cache(maxsize=300_000)
def _is_multibyte_damage(token: str) -> bool:
    """Whether a token is UTF-8 read in one of the two usual ways, which no written word looks like by chance."""
    return any(c.undo(token) is not None for c in channels()[0][:2])


@lru_cache(maxsize=1)
def _any_multibyte() -> re.Pattern:
    return re.compile("|".join(c.pattern.pattern for c in channels()[0]))


class Counts(NamedTuple):
    """Hashes of keys, ascending, and how often each was counted: 16 bytes a key."""

    hashes: np.ndarray
    counts: np.ndarray

    def name(self) -> int:
        return hash((self.hashes.tobytes(), self.counts.tobytes()))


def word_frequencies(documents: DataFrame, text: str) -> Counts:
    """The counts of all tokens beyond ASCII and their character contexts, over all documents.

    Damage gives itself no support: tokens that are UTF-8 read in one of the two usual ways are not counted, and under these
    first counts a second pass finds what other channels have damaged (``Decoder.damaged``), whose counts are taken out."""
    first = _summed(documents, text, None)
    sent = documents.sparkSession.sparkContext.broadcast(first)  # 16 bytes for each distinct word or context
    out = _summed(documents, text, (first.name(), sent))
    left = first.counts.copy()
    left[np.searchsorted(first.hashes, out.hashes)] -= out.counts
    return Counts(first.hashes[left > 0], left[left > 0])


def _summed(documents: DataFrame, text: str, under: tuple | None) -> Counts:
    """The counts of all tokens, or of the damaged ones only, ``under`` other counts (their name and broadcast). Every task sums its
    own counts first; the driver gets one row for each distinct word or context."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens: Counter[bytes] = Counter()
        decoder = _decoder(*under) if under else None

        def emit() -> pd.DataFrame:
            sums: Counter[str] = Counter()
            for raw, n in tokens.items():
                token = raw.decode("utf-8", "surrogatepass")
                if LOST not in token and not _is_multibyte_damage(token):
                    sums[token_key(token)] += n
                    for context in contexts(token):
                        sums["\x01" + context] += n
            tokens.clear()
            if not sums:
                return pd.DataFrame({"slot": np.zeros(0, dtype=np.int64), "n": np.zeros(0, dtype=np.int64)})
            return pd.DataFrame({"slot": np.fromiter(map(_hash_of, sums), dtype=np.int64, count=len(sums)), "n": np.fromiter(sums.values(), dtype=np.int64, count=len(sums))})

        for batch in batches:
            for _, texts in _pieces(batch["_text"].tolist()):
                data, _, rows, starts, ends = _foreign_tokens(texts)
                raw = [data[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                tokens.update(raw if decoder is None else decoder.damaged(raw, rows))
                if len(tokens) > 500_000:
                    yield emit()
        yield emit()

    counted = documents.where(F.col(text).isNotNull()).select(F.col(text).alias("_text")).mapInPandas(count, "slot bigint, n bigint")
    rows = counted.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # 16 bytes for each distinct word or context
    hashes, counts = rows["slot"].to_numpy(dtype=np.int64), rows["n"].to_numpy(dtype=np.int64)
    order = np.argsort(hashes)
    return Counts(hashes[order], counts[order])


def entry_cost(name: str) -> float:
    """Price of a change to a channel; to text as it stands it is the cheapest."""
    if not name:
        return SWITCH / 2
    return SWITCH + (0.0 if name.startswith("utf-8") else SINGLE_COST)


class Decoder:
    """Restores texts under the corpus frequencies."""

    def __init__(self, counts: Counts):
        self.hashes, self.logs = counts.hashes, np.log(counts.counts * (COUNTED / max(1, int(counts.counts.sum()))) + 0.1)
        self.multi, self.single = channels()
        self.by_name = {c.name: c for c in [*self.multi, *self.single]}
        self.seen: dict[str, float] = {}
        self.better: dict[str, tuple[tuple[str, float], ...]] = {}
        self.turned: dict[str, tuple[tuple[str, float], ...]] = {}
        self.after: dict[str, list[str]] = {}
        self.readings: dict[tuple[str, str], tuple[str, float] | None] = {}

    def _log_count(self, key: str) -> float:
        found = self.seen.get(key)
        if found is None:
            if len(self.seen) > 2_000_000:
                self.seen.clear()
            h = np.int64(_hash_of(key))
            at = self.hashes.searchsorted(h)
            found = self.seen[key] = float(self.logs[at]) if at < len(self.hashes) and self.hashes[at] == h else math.log(0.1)
        return found

    def score(self, token: str) -> float:
        """How usual a reading is: by its word, or by its letters in context if the word is rare."""
        if token.isascii():
            return 0.0
        by_letters = min(self._log_count("\x01" + c) for c in contexts(token))
        return max(self._log_count(token_key(token)), 0.6 * by_letters - 1.0) - (MIXED if _MIXED.search(token) else 0.0)

    def _following(self, state: str) -> list[str]:
        """The letters that the corpus has often after two characters."""
        if state not in self.after:
            if len(self.after) > 50_000:
                self.after.clear()
            hashes = np.array([_hash_of(f"\x01{state}{c}") for c in _LETTERS], dtype=np.int64)
            at = np.minimum(self.hashes.searchsorted(hashes), len(self.hashes) - 1)
            usual = np.flatnonzero((self.hashes[at] == hashes) & (self.logs[at] > 1.0)) if len(self.hashes) else []
            self.after[state] = [_LETTERS[k] for k in usual]
        return self.after[state]

    def _paths(self, lattice: Iterable[Sequence[Edge]], size: int, lost: bool) -> list[tuple[str, ...]]:
        """The likeliest paths through a lattice of ``size`` places, each as what it says as the token stands and after each channel.

        Viterbi search with the last two characters as state and several paths in each. If characters are ``lost``, a path with a character in a context that
        the corpus hardly has cannot end in a frequent word and is dropped, whatever their number."""
        places: list[dict[str, list[tuple]]] = [{} for _ in range(size + 1)]
        places[0]["  "] = [(0.0, (), None)]
        for at, edges in enumerate(lattice):
            states, places[at] = places[at], {}
            if not states:
                continue
            best = {state: sorted(paths, key=_first, reverse=True)[: PATHS if lost else SOUND_PATHS] for state, paths in states.items()}
            if sum(map(len, best.values())) > BEAM:
                least = sorted((p[0] for paths in best.values() for p in paths), reverse=True)[BEAM - 1]
                best = {state: kept for state, paths in best.items() if (kept := [p for p in paths if p[0] >= least])}
            steps: dict[str, list[tuple]] = {}
            for end, forms in edges:
                price = LEFT_OVER if len(forms) > 1 and forms[0] == forms[-1] >= "\x80" else 0.0
                steps.setdefault(_KEY.sub(" ", forms[-1]), []).append((end, forms, price))
            for state, paths in best.items():
                is_open = state[1] >= "\x80"
                # where all letters may follow, only those that the corpus has are looked at
                usual = self._following(state) if lost and is_open and len(steps) >= len(_LETTERS) else None
                for seen in steps if usual is None else (c for c in (*usual, *_SIGNS) if c in steps):
                    gain = self._log_count(f"\x01{state}{seen[0]}") if is_open else 0.0
                    if not lost or not is_open or gain > 1.0:
                        after = (state + (seen[1:] if seen[0] == " " == state[1] else seen))[-2:]
                        for end, forms, price in steps[seen]:
                            places[end].setdefault(after, []).extend([(path[0] + gain - price, forms, path) for path in paths])
        found = []
        for state, paths in places[-1].items():
            gain = self._log_count(f"\x01{state} ") if state[1] >= "\x80" else 0.0
            if not lost or state[1] < "\x80" or gain > 1.0:
                found += [(path[0] + gain, path) for path in sorted(paths, key=_first, reverse=True)[: PATHS if lost else SOUND_PATHS]]
        texts = []
        for _, path in found:
            parts = []
            while path[2] is not None:
                parts.append(path[1])
                path = path[2]
            texts.append(tuple(map("".join, zip(*reversed(parts), strict=True))))
        return texts

    def _scored(self, forms: tuple[str, ...], name: str, filled: bool) -> tuple[float, str] | None:
        """The score and the text of a path through the lattice of a chain of channels; None if it leaves out one or, lost characters ``filled``, is no word of the corpus."""
        token, text, levels = forms[0], forms[-1], len(name.split("|")) if name else 0
        if any(a == b for a, b in zip(forms[:levels], forms[1 : levels + 1], strict=True)):
            return None
        if filled:
            score = self._log_count(token_key(text))
            if score <= 1.0:
                return None
            score -= MIXED if _MIXED.search(text) else 0.0
        else:
            score = self.score(text)
        plain, last, sound = self.score(token), score, 0
        for level in range(1, levels + 1):
            # beyond the first, a valid sequence counts only if it does not make a usual word an unusual one
            before, plain = plain, last if level == levels else self.score(forms[level])
            sound += level == 1 or plain >= before
        if name:
            held = set(token)
            left = sum(1 for c in text if c >= "\x80" and c in held)
            score += VALID * sound - MULTIBYTE_COST - LEFT_OVER * left - 0.01 * self.multi.index(self.by_name[name.split("|")[0]])
        return score, text

    def read(self, token: str, name: str) -> tuple[str, float] | None:
        """The reading of a token under a channel, or a chain of channels, and its score; None if it does not fit.

        The channel of a token as it stands is ''. Lost characters are filled if that gives a word that the corpus has often, and stand if not."""
        try:
            return self.readings[token, name]
        except KeyError:
            pass
        if name and not name.startswith("utf-8"):
            text = self.by_name[name].undo(token)
            found = None if text is None else self.read(text, "") if LOST in text else (text, self.score(text))
            if found and text != token:
                found = (found[0], found[1] - 0.3)
        else:
            found = self._best(token, name, True) if LOST in token else None
            if found is None:
                found = self._best(token, name, False) if name else (token, self.score(token))
        if len(self.readings) > 500_000:
            self.readings.clear()
        self.readings[token, name] = found
        return found

    def _best(self, token: str, name: str, lost: bool) -> tuple[str, float] | None:
        """The best path through a token's lattice under a chain of UTF-8 channels or none, ``lost`` characters filled or standing."""
        parts = [self.by_name[part] for part in name.split("|")] if name else []
        if not lost:
            # no place where one sequence may stand and another be put right: the path is known
            forms, several = [token], False
            for channel in parts:
                text = channel.undo(forms[-1])
                if text is None:
                    return None
                several = several or len(channel.pattern.findall(forms[-1])) > 1
                forms.append(text)
            if not several:
                score, text = self._scored(tuple(forms), name, False)
                return text, score
        lattice: Lattice | None = lattice_of(token)
        if not name and any(LOST not in c and self._log_count("\x01" + c) <= 1.0 for c in contexts(token)):
            return None
        for channel in parts:
            lattice = channel.unread(lattice, lost)
            if lattice is None:
                return None
        paths = self._paths(with_letters(lattice, any(c.isalpha() for c in token)) if lost else lattice, len(lattice), lost)
        score, text = max((found for forms in paths if (found := self._scored(forms, name, lost))), default=(0.0, None))
        return None if text is None else (text, score)

    def _chains(self, token: str) -> list[str]:
        """The chains of UTF-8 channels under which a token has valid sequences, one for each text that they give when all are put right."""
        names, level = [], {token: ""}
        for _ in range(DEPTH):
            following: dict[str, str] = {}
            for text, name in level.items():
                for channel in self.multi:
                    if (changed := channel.undo(text)) is not None:
                        following.setdefault(changed, f"{name}|{channel.name}".lstrip("|"))
            names += following.values()
            level = following
        return names

    def _lost_chains(self, token: str) -> list[str]:
        """As ``_chains``, with lost characters as bytes: one for each lattice."""
        names, level = [], [(lattice_of(token), "")]
        for _ in range(DEPTH):
            following: dict[tuple, tuple[Lattice, str]] = {}
            for lattice, name in level:
                for channel in self.multi if sum(map(len, lattice)) <= EDGES else ():
                    if (changed := channel.unread(lattice, True)) is not None:
                        said = tuple((end, forms[-1]) for edges in changed for end, forms in edges)
                        following.setdefault(said, (changed, f"{name}|{channel.name}".lstrip("|")))
            level = list(following.values())
            names += [name for _, name in level]
        return names

    def better_channels(self, token: str) -> tuple[tuple[str, float], ...]:
        """The channels under which a token reads better than as it stands, and by how much."""
        found = self.better.get(token)
        if found is not None:
            return found
        plain = self.read(token, "")[1] if LOST in token else self.score(token)
        names = []
        if LOST in token or _any_multibyte().search(token):
            names = self._lost_chains(token) if LOST in token else self._chains(token)
            names = [(n, read[1] - plain) for n in names if (read := self.read(token, n)) and read[1] > plain + 0.5]
        names += [(name, gain) for name, gain in self.single_gains(token) if gain > 0.8]
        if len(self.better) > 500_000:
            self.better.clear()
        self.better[token] = tuple(names)
        return self.better[token]

    def single_gains(self, token: str) -> tuple[tuple[str, float], ...]:
        """The single-byte channels under which a token is a word that the corpus knows, not much less likely than as it stands, and its gain."""
        found = self.turned.get(token)
        if found is None:
            plain, key, gains = self.read(token, "")[1] if LOST in token else self.score(token), token_key(token), []
            for channel in self.single:
                if (changed := channel.undo(key)) is not None and changed != key:
                    text = self.read(token, channel.name)[0] if LOST in token else None
                    gain = self._log_count(token_key(text) if text else changed) - plain
                    if gain > -LESS_LIKELY and gain + plain > 0.8 and not _MIXED.search(text or channel.undo(token)):
                        gains.append((channel.name, gain))
            if len(self.turned) > 500_000:
                self.turned.clear()
            found = self.turned[token] = tuple(gains)
        return found

    def damaged(self, raw: list[bytes], rows: np.ndarray) -> Iterator[bytes]:
        """Those of the tokens, in the order of their texts ``rows``, that a channel has damaged.

        UTF-8 shows in a token alone. A single-byte channel shows where it turns several different words beside each other into
        likelier ones: one such word may be a word of its own, and where a whole source is damaged its words are frequent themselves."""
        read = {r: r.decode("utf-8", "surrogatepass") for r in set(raw)}
        read = {r: t for r, t in read.items() if LOST not in t and not _is_multibyte_damage(t)}
        utf8 = {r for r, t in read.items() if any(n.startswith("utf-8") for n, _ in self.better_channels(t))}
        gains = {r: dict(self.single_gains(t)) for r, t in read.items() if r not in utf8}
        likelier = {r for r, g in gains.items() if any(x > 0 for x in g.values())}
        yield from (r for r in raw if r in utf8)
        at = np.flatnonzero(np.fromiter((r in likelier for r in raw), dtype=bool, count=len(raw)))
        texts, counts = np.unique(rows[at], return_counts=True)
        for row in texts[counts >= SUPPORTERS].tolist():
            low, high = np.searchsorted(rows, [row, row + 1]).tolist()
            part = raw[low:high]
            votes = Counter(n for r in set(part) & likelier for n, x in gains[r].items() if x > 0)
            out: set[int] = set()
            for name in (n for n, v in votes.items() if v >= SUPPORTERS):
                channel = self.by_name[name]
                begin = 0
                for k in range(len(part) + 1):
                    if k < len(part) and (name in gains.get(part[k], ()) or part[k] in read and channel.undo(t := token_key(read[part[k]])) == t):
                        continue
                    held = {r for r in part[begin:k] if gains.get(r, {}).get(name, 0.0) > 0}
                    less = {r for r in part[begin:k] if gains.get(r, {}).get(name, 1.0) <= 0}
                    if len(held) >= SUPPORTERS and len(held) > len(less):
                        out.update(j for j in range(begin, k) if name in gains.get(part[j], ()))
                    begin = k + 1
            yield from (part[j] for j in sorted(out))

    def path(self, tokens: list[str], names: list[str]) -> list[str]:
        """The readings of a document's tokens, by the Viterbi search over channels."""
        scores: dict[str, float] = {"": 0.0}
        back: list[dict[str, str]] = []
        for token in tokens:
            best_name, best = max(scores.items(), key=lambda x: x[1])
            new, came = {}, {}
            for name in names:
                read = self.read(token, name)
                if read is None:
                    continue
                stay = scores.get(name, -math.inf)
                cost = entry_cost(name)
                came[name] = name if stay >= best - cost else best_name
                new[name] = max(stay, best - cost) + read[1]
            scores = new
            back.append(came)
        name = max(scores, key=scores.__getitem__)
        chosen = []
        for came in reversed(back):
            chosen.append(name)
            name = came[name]
        chosen.reverse()
        return [self.read(token, n)[0] for token, n in zip(tokens, chosen, strict=True)]

    def restore(self, texts: list[str]) -> Iterator[tuple[int, str]]:
        """(position, restored text) of the texts that change."""
        for low, part in _pieces(texts):
            data, begins, rows, starts, ends = _foreign_tokens(part)
            raw = [data[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            read = {r: r.decode("utf-8", "surrogatepass") for r in set(raw)}
            marked = {r for r, token in read.items() if LOST in token or self.better_channels(token)}
            if not marked:
                continue
            first = np.searchsorted(rows, np.arange(len(part) + 1))
            for row in np.unique(rows[np.fromiter((r in marked for r in raw), dtype=bool, count=len(raw))]).tolist():
                span = range(int(first[row]), int(first[row + 1]))
                tokens = [read[raw[i]] for i in span]
                readings = self._readings(tokens)
                if readings != tokens:
                    out, last = [], int(begins[row])
                    for i, reading in zip(span, readings, strict=True):
                        out += [data[last : starts[i]], reading.encode("utf-8", "surrogatepass")]
                        last = int(ends[i])
                    yield low + row, b"".join([*out, data[last : begins[row + 1] - 1]]).decode("utf-8", "surrogatepass")

    def _readings(self, tokens: list[str]) -> list[str]:
        gains: Counter[str] = Counter()
        for token in tokens:
            for name, gain in self.better_channels(token):
                gains[name] += gain
        # a channel that gains less than it costs to enter is on no best path
        names = [n for n, gain in gains.items() if gain > entry_cost(n)]
        return self.path(tokens, ["", *sorted(names)]) if names else [self.read(t, "")[0] if LOST in t else t for t in tokens]


_DECODERS: dict[int, Decoder] = {}


def _decoder(name: int, sent) -> Decoder:
    """The worker's decoder for some counts: it and what it has read stay for the tasks to come."""
    if name not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[name] = Decoder(sent.value)
    return _DECODERS[name]


def restore_encoding(documents: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """(key, restored_sha256, lost, restored_text) of the documents with wrongly decoded text.

    ``restored_sha256`` is that of the whole restored text in UTF-8; it is '' if the stored text holds U+FFFD, as characters are then
    lost for good (``restored_text`` has the likely ones). NULL, empty and undamaged texts give no rows; copies give a row each.
    Three passes over the whole texts; nothing but the counts is shuffled."""
    frequencies = word_frequencies(documents, text)
    sent = documents.sparkSession.sparkContext.broadcast(frequencies)  # 16 bytes for each distinct word or context
    name = frequencies.name()
    schema = "_key string, restored_sha256 string, lost boolean" + ", restored_text string" * with_text

    def restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = _decoder(name, sent)
        for batch in batches:
            texts, keys, out = batch["_text"].tolist(), batch["_key"], []
            changed = dict(decoder.restore(texts))
            for row, body in enumerate(texts):
                lost = LOST in body
                if lost or row in changed:
                    new = changed.get(row, body)
                    digest = "" if lost else hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((keys.iloc[row], digest, lost, *([new] if with_text else [])))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    picked = documents.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"))
    rows = picked.mapInPandas(restore, schema)
    return rows.select(F.col("_key").cast(documents.schema[key].dataType).alias(key), *rows.columns[1:])
