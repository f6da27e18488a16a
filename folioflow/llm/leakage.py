"""Evaluation texts leaking into training text.

Passages of the items, windows as long as the part of an item that counts (16 words at most), have SimHash fingerprints over their
weighted words. The windows of a document whose words could make up such a passage at all are fingerprinted too. A multi-index over blocks of
the fingerprint's bits gives every passage within the radius: of two fingerprints that differ in ``RADIUS`` bits at most, one of the
``BLOCKS`` blocks differs in ``RADIUS // BLOCKS`` at most, and all such block values are looked up. What is found is verified by the exact weighted similarity of
the two windows; then the item's words that the whole document holds in order are counted, in stretches between whose words a few
may be changed, added or dropped."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most words of a window, and the distance of a document's windows. A passage with a word in four changed, added or dropped keeps some window within the radius.
WINDOW, STEP = 16, 2
#: Bits in which fingerprints of 64 may differ, and the blocks of 16 they are looked up by.
RADIUS, BLOCKS = 11, 4
#: Least part of the weight of either window that must stand in the other.
SIMILARITY = 0.6
SHARE = 0.4
#: Test items in one pass over the corpus; more are taken in further passes.
ITEM_BLOCK = 5_000
#: Greatest number of words between two held words of one stretch, and fewest words of a stretch.
GAP, STRETCH = 2, 5

_DROPPED = b"\"'.,-():;!?*_`#[]{}~^%$&@+="
_LAYOUT = bytes.maketrans(b"|/\\<>\t\r\n\f\v", b" " * 10)
_WIDE_SPACES = "\u2012\u2013\u2014\u2015\u2212\u2028\u2029\u0085"
_IGNORED = re.compile("[\u2010\u2011\u2018-\u201f\u00ab\u00bb\u00a3\u20ac\u00a7\u2022\u00b7\u2032\u2033\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]+")
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>|<!--.*?-->", re.S)


def words(text: str) -> list[bytes]:
    """The words of a text, in UTF-8, without case, punctuation, layout, markup and invisible characters."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if text.isascii():
        return text.lower().encode().translate(_LAYOUT, _DROPPED).split()
    text = _IGNORED.sub("", text)
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    for ch in _WIDE_SPACES:
        if ch in text:
            text = text.replace(ch, " ")
    return text.casefold().encode("utf-8", "replace").translate(_LAYOUT, _DROPPED).split()


@lru_cache(maxsize=1_000_000)
def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """One row of 64 values -1 or 1 for each hash."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.float32) * 2 - 1


def weights_of(found: list[bytes]) -> np.ndarray:
    """Weights of words: less for short ones. They depend on the word alone, so fingerprints change neither with the items nor with the corpus."""
    return np.minimum(np.fromiter(map(len, found), dtype=np.float32, count=len(found)) / 6, 1)


def window_size(words_of_item: int, share: float = SHARE) -> int:
    """Words of an item's passages: the part that counts, a stretch at least, ``WINDOW`` at most; all of an item that is shorter than a stretch."""
    return min(words_of_item, WINDOW, max(STRETCH, -int(-share * words_of_item // 1)))


class Passages:
    """The windows of one size of some texts, by the blocks of their fingerprints."""

    def __init__(self, texts: list[np.ndarray], owners: list[int], size: int, lanes: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        if 64 % blocks or 64 // blocks > 16:
            raise ValueError("blocks of 16 bits at most are needed")
        self.size, self.radius, self.blocks, self.bits, self.lanes = size, radius, blocks, 64 // blocks, lanes
        counts = [len(t) - size + 1 for t in texts]
        self.owner = np.repeat(np.array(owners, dtype=np.int64), counts)
        self.words = np.concatenate([np.lib.stride_tricks.sliding_window_view(t, size) for t in texts]) if texts else np.zeros((0, size), dtype=np.int64)
        self.prints = self.fingerprints(self.words)
        values = np.arange(1 << self.bits, dtype=np.int64)
        #: what a block's value may differ by
        self.masks = values[np.bitwise_count(values) <= radius // blocks]
        self.order, self.offsets = [], []
        for block in range(blocks):
            keys = self._keys(self.prints, block)
            self.order.append(np.argsort(keys, kind="stable"))
            self.offsets.append(np.concatenate(([0], np.cumsum(np.bincount(keys, minlength=1 << self.bits)))))

    def fingerprints(self, windows: np.ndarray) -> np.ndarray:
        """SimHash of windows of word numbers; the last lane is that of words that no item has, and empty."""
        out = np.zeros(len(windows), dtype=np.uint64)
        for low in range(0, len(windows), 4096):
            total = self.lanes[windows[low : low + 4096]].sum(axis=1)
            out[low : low + 4096] = np.packbits(total > 0, axis=1, bitorder="little").view("<u8").ravel()
        return out

    def _keys(self, prints: np.ndarray, block: int) -> np.ndarray:
        return ((prints >> np.uint64(block * self.bits)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def within_radius(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, passage) pairs of all fingerprints within the radius, some thousand queries at a time; a pair may come again."""
        for low in range(0, len(prints), 512):
            part = prints[low : low + 512]
            for block in range(self.blocks):
                keys = (self._keys(part, block)[:, None] ^ self.masks).ravel()
                begin = self.offsets[block][keys]
                sizes = self.offsets[block][keys + 1] - begin
                full = np.flatnonzero(sizes)
                begin, sizes = begin[full], sizes[full]
                within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                passage = self.order[block][np.repeat(begin, sizes) + within]
                query = np.repeat(full // len(self.masks), sizes)
                near = np.bitwise_count(part[query] ^ self.prints[passage]) <= self.radius
                yield low + query[near], passage[near]


def similarity(left: np.ndarray, left_weights: np.ndarray, right: np.ndarray, right_weights: np.ndarray) -> np.ndarray:
    """The smaller of the two parts of the windows' weights whose words stand in the other window; -1 stands nowhere."""
    equal = (left[:, :, None] == right[:, None, :]) & (left >= 0)[:, :, None]
    one = (equal.any(axis=2) * left_weights).sum(axis=1) / left_weights.sum(axis=1)
    two = (equal.any(axis=1) * right_weights).sum(axis=1) / right_weights.sum(axis=1)
    return np.minimum(one, two)


class ItemIndex:
    """The passages of a block of test items, and where each item has its word pairs."""

    def __init__(self, items: list[tuple[object, str]], share: float = SHARE):
        self.ids = [i for i, _ in items]
        texts = [words(t) for _, t in items]
        seen = dict.fromkeys(word for text in texts for word in text)
        self.known = {word: k for k, word in enumerate(seen)}
        self.weights = np.append(weights_of(list(seen)), np.float32(0))
        hashes = np.array([*map(_hash, seen), 0], dtype=np.uint64)
        self.texts = [np.array([self.known[w] for w in t], dtype=np.int64) for t in texts]
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        lanes = _signs(hashes) * self.weights[:, None]
        by_size: dict[int, list[int]] = {}
        for k, n in enumerate(self.sizes.tolist()):
            if n:
                by_size.setdefault(window_size(n, share), []).append(k)
        self.passages = [Passages([self.texts[k] for k in own], own, size, lanes) for size, own in sorted(by_size.items())]
        self.pair_positions: dict[int, dict[int, list[int]]] = {}

    def candidates(self, ids: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, item) of which a window of the row's text and a passage of the item are within the radius and similar.

        ``ids``: the numbers of the texts' words, -1 for words that no item has, -2 between texts. A window of which too little weight is in
        known words is similar to no passage and is not looked up."""
        found = [np.zeros(0, dtype=np.int64)]
        held = np.concatenate(([0.0], np.cumsum(np.where(ids >= 0, weights, 0.0))))
        whole = np.concatenate(([0.0], np.cumsum(weights)))
        ends = np.concatenate(([0], np.cumsum(ids == -2)))
        for passages in self.passages:
            size = passages.size
            at = np.arange(0, max(0, len(ids) - size + 1), STEP if size > STRETCH else 1)
            share = held[at + size] - held[at] >= SIMILARITY * (whole[at + size] - whole[at]) - 1e-6
            at = at[share & (ends[at + size] == ends[at]) & (held[at + size] > held[at])]
            for begin in range(0, len(at), 65_536):
                starts = at[begin : begin + 65_536]
                windows = ids[starts[:, None] + np.arange(size)]
                for query, passage in passages.within_radius(passages.fingerprints(windows)):
                    for low in range(0, len(query), 20_000):
                        q, p = query[low : low + 20_000], passage[low : low + 20_000]
                        own = passages.words[p]
                        alike = similarity(windows[q], weights[starts[q][:, None] + np.arange(size)], own, self.weights[own]) >= SIMILARITY
                        found.append(np.unique(rows[starts[q[alike]]] * len(self.texts) + passages.owner[p[alike]]))
        both = np.unique(np.concatenate(found))
        yield from zip((both // max(len(self.texts), 1)).tolist(), (both % max(len(self.texts), 1)).tolist(), strict=True)

    def shares(self, texts: list[str]) -> Iterator[tuple[int, int, float]]:
        """(text, item, share of the item's words held) of the texts that have a passage of an item."""
        known, block = self.known.get, 2_000_000
        low = 0
        while low < len(texts):
            parts, lengths, high, size = [], [], low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= block):
                found = words(texts[high])
                parts += [np.fromiter(map(known, found, repeat(-1)), dtype=np.int64, count=len(found)), np.array([-2])]
                lengths += [weights_of(found), np.zeros(1, dtype=np.float32)]
                size, high = size + len(texts[high]), high + 1
            begins = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts[::2]])))
            ids = np.concatenate(parts)
            rows = np.repeat(np.arange(high - low), np.diff(begins))
            for k, item in self.candidates(ids, np.concatenate(lengths), rows):
                if held := self.held_share(item, ids[begins[k] : begins[k + 1]]):
                    yield low + k, item, held
            low = high

    def _pairs_of(self, item: int) -> dict[int, list[int]]:
        """Where an item has each of its pairs of neighbouring words."""
        if item not in self.pair_positions:
            at: dict[int, list[int]] = {}
            ids = self.texts[item]
            for p, pair in enumerate((ids[:-1] * len(self.known) + ids[1:]).tolist()):
                at.setdefault(pair, []).append(p)
            self.pair_positions[item] = at
        return self.pair_positions[item]

    def held_share(self, item: int, ids: np.ndarray) -> float:
        """Share of the item's words that a text holds in order."""
        positions, n = self._pairs_of(item), int(self.sizes[item])
        if n == 1:
            return float((ids == self.texts[item][0]).any())
        pairs = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.known) + ids[1:], -1)
        at = np.flatnonzero(np.isin(pairs, np.fromiter(positions, dtype=np.int64, count=len(positions))))
        shortest = min(STRETCH, n)
        # pairs further apart are of no one stretch, and too few are no stretch
        starts = np.flatnonzero(np.diff(at, prepend=-(10**9)) > GAP + 2)
        counts = np.diff(np.append(starts, len(at)))
        at = at[np.repeat(counts + 1 >= shortest, counts)]
        matches = [(d, p) for d, pair in zip(at.tolist(), pairs[at].tolist(), strict=True) for p in positions[pair]]
        return sum(e - b for b, e in _stretches(matches, shortest)) / n


def _stretches(matches: list[tuple[int, int]], shortest: int = STRETCH) -> list[tuple[int, int]]:
    """Item ranges of the stretches of matching word pairs (document position, item position), in order and apart."""
    open_at: dict[int, list[int]] = {}
    runs = []
    for d, p in sorted(matches):
        # a run goes on if a few words at most were changed, added or dropped on either side
        best = None
        for shift in range(p - d - GAP - 1, p - d + GAP + 2):
            run = open_at.get(shift)
            if run and 0 < p - run[3] <= GAP + 2 and 0 < d - run[1] <= GAP + 2 and (best is None or run[3] > best[3]):
                best = run
        if best is None:
            best = [d, d, p, p, 0]
            runs.append(best)
        elif open_at.get(best[3] - best[1]) is best:
            del open_at[best[3] - best[1]]
        best[1], best[3], best[4] = d, p, best[4] + 1
        open_at[p - d] = best
    # runs hold pairs: a range ends one word further; the heaviest chain of runs that are in order in both texts counts
    kept = sorted(((r[1] + 2, r[0], r[2], r[3] + 2) for r in runs if r[4] + 1 >= shortest), key=lambda r: r[1])
    best_chain: list[tuple[int, list[tuple[int, int]], int, int]] = []
    for d_end, d_begin, p_begin, p_end in kept:
        weight, chain = 0, []
        for w, c, d_last, p_last in best_chain:
            if w > weight and d_last <= d_begin + GAP and p_last <= p_begin + GAP:
                weight, chain = w, c
        begin = max(p_begin, chain[-1][1] if chain else 0)
        if p_end > begin:
            best_chain.append((weight + p_end - begin, [*chain, (begin, p_end)], d_end, p_end))
    return max(best_chain, key=lambda b: b[0])[1] if best_chain else []


_INDEXES: dict[str, ItemIndex] = {}


def _index(name: str, sent, share: float) -> ItemIndex:
    """The worker's index of a block of items, kept for the tasks to come."""
    if name not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name] = ItemIndex(sent.value, share)
    return _INDEXES[name]


def leaked_items(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", share: float = SHARE
) -> DataFrame:
    """(key, item key, share) of every document that holds at least ``share`` of an item's words, in order, in stretches.

    Whole texts are read, of all documents, once for each ``ITEM_BLOCK`` items; nothing is shuffled, and rows do not depend on the blocks.
    NULL and empty texts leak nothing; an item shorter than a stretch has to be held whole; copies of a document are rows of their own."""
    held = items.where(F.col(item_text).isNotNull()).select(F.col(item_key).alias("_item"), F.col(item_text).alias("_text")).toLocalIterator()
    schema = f"_key string, {item_key} {dict(items.dtypes)[item_key]}, share double"
    result = None
    while (block := [tuple(r) for r in islice(held, ITEM_BLOCK)]) or result is None:
        part = _leaks_of_block(documents, key, text, block, schema, share)
        result = part if result is None else result.unionByName(part)
    return result


def _leaks_of_block(documents: DataFrame, key: str, text: str, block: list[tuple], schema: str, share: float) -> DataFrame:
    import xxhash

    context = documents.sparkSession.sparkContext
    sent = context.broadcast(block)  # at most ITEM_BLOCK texts
    name = xxhash.xxh64_hexdigest(repr((share, block)))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index(name, sent, share)
        for batch in batches:
            out = []
            for row, item, held in index.shares(batch["_text"].tolist()):
                if held >= share - 1e-9:
                    out.append((batch["_key"].iloc[row], index.ids[item], held))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    picked = documents.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"))
    rows = picked.mapInPandas(search, schema)
    return rows.select(F.col("_key").cast(documents.schema[key].dataType).alias(key), *rows.columns[1:])
