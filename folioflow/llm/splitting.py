"""Splitting oversized items at natural boundaries.

Every gap between two tokens has a boundary strength. A sparse table over the strengths answers range-maximum
queries in constant time: each cut is the strongest gap in the window of permissible lengths, the rightmost of equals;
the next piece begins the overlap earlier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP, LEAST_FILL = 8192, 128, 0.5
WHITE = (32, 9, 13, 10)
# Strengths of a gap, from the hardest to the softest boundary.
HEADING, PARAGRAPH, ROW, LINE, SENTENCE, CLAUSE, WORD = 7, 6, 5, 4, 3, 2, 1


def token_count(text: Column) -> Column:
    """Number of longest runs of characters other than space, tab, carriage return and line feed; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\r\n]+")), F.lit(0))


def token_bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens in an array of code points."""
    inside = ~np.isin(points, WHITE)
    edges = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def boundary_strengths(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Strength of a cut before each token; that of the first token is 0."""
    n = len(starts)
    strength = np.full(n, WORD, dtype=np.int8)
    if n == 0:
        return strength
    # line ends: LF, CR LF or a lone CR
    line_end = (points == 10) | ((points == 13) & np.append(points[1:] != 10, True))
    lines = np.concatenate(([0], np.cumsum(line_end)))
    breaks = np.append(0, lines[starts[1:]] - lines[ends[:-1]])
    final = points[ends - 1]
    before_closer = points[np.maximum(ends - 2, starts)]
    closers = np.isin(final, [ord(c) for c in "\"'”’»)]"])
    stop = np.where(closers, before_closer, final)
    last = np.append(0, stop[:-1])
    strength[np.isin(last, [ord(c) for c in ",;:–—"])] = CLAUSE
    strength[np.isin(last, [ord(c) for c in ".!?…;·"]) & (last != ord(";"))] = SENTENCE
    first = points[starts]
    strength[breaks == 1] = LINE
    strength[(breaks == 1) & (first == ord("|"))] = ROW
    strength[breaks >= 2] = PARAGRAPH
    strength[(breaks >= 1) & (first == ord("#"))] = HEADING
    strength[0] = 0
    return strength


class SparseTable:
    """Index of the rightmost maximum of any range of an array, in constant time after n log n work."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.values = values.astype(np.int64)
        self.levels = [np.arange(n)]
        width = 1
        while 2 * width <= n:
            low = self.levels[-1][: n - 2 * width + 1]
            high = self.levels[-1][width : n - width + 1]
            self.levels.append(np.where(self.values[high] >= self.values[low], high, low))
            width *= 2

    def rightmost_maximum(self, low: int, high: int) -> int:
        """Position in [low, high]; the range must not be empty."""
        level = (high - low + 1).bit_length() - 1
        a, b = self.levels[level][low], self.levels[level][high - (1 << level) + 1]
        return int(b if self.values[b] >= self.values[a] else a)


def cut_points(strengths: np.ndarray, limit: int, overlap: int, least: int) -> list[tuple[int, int]]:
    """Token ranges [begin, end) of the pieces: each at most ``limit`` long and, but for the last, at least ``least``;
    each begins ``overlap`` tokens before the end of the one before it."""
    if not 0 <= overlap < least <= limit:
        raise ValueError("overlap < least <= limit must hold")
    n, begin, pieces = len(strengths), 0, []
    if n <= limit:
        return [(0, n)]
    table = SparseTable(strengths)
    while n - begin > limit:
        end = table.rightmost_maximum(begin + least, begin + limit)
        pieces.append((begin, end))
        begin = end - overlap
    pieces.append((begin, n))
    return pieces


def split_text(text: str, limit: int, overlap: int, least: int) -> list[tuple[int, int, int, int]]:
    """(first token, tokens, first character, end character) of each piece."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts, ends = token_bounds(points)
    if len(starts) == 0:
        return []
    return [(b, e - b, int(starts[b]), int(ends[e - 1])) for b, e in cut_points(boundary_strengths(points, starts, ends), limit, overlap, least)]


def split_oversized(
    items: DataFrame, key: str, text: str, header: str | None = None, limit: int = LIMIT, overlap: int = OVERLAP, least_fill: float = LEAST_FILL, with_text: bool = True
) -> DataFrame:
    """(key, piece_no, first_token, n_tokens, boundary..., piece) of the items whose header and text exceed ``limit`` tokens.

    Every piece keeps the item's header, so header and piece stay under the limit together. A header that leaves less
    than twice the overlap (at least 2 tokens) is itself split in front of the text, as text. Texts that are NULL
    count as empty; items within the limit give no rows. Whole texts are read, each by itself: no shuffle, no collection."""
    head = F.coalesce(F.col(header), F.lit("")) if header else F.lit("")
    body = F.coalesce(F.col(text), F.lit(""))
    # n tokens need 2n - 1 characters (header and text are parted by a line), so short texts need no counting
    long_enough = items.where(F.length(head) + F.length(body) >= 2 * limit)
    oversized = long_enough.where(token_count(head) + token_count(body) > limit)
    schema = "_key string, piece_no int, first_token int, n_tokens int, start_char int, end_char int, header_tokens int" + ", piece string" * with_text

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, h, b in zip(batch["_key"], batch["_head"], batch["_body"], strict=True):
                kept = len(token_bounds(np.frombuffer(h.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))[0]) if h else 0
                room = limit - kept
                if room < max(2, 2 * overlap + 2):
                    h, b, kept, room = "", f"{h}\n{b}", 0, limit
                least = max(overlap + 1, int(room * least_fill))
                for no, (first, n, start, end) in enumerate(split_text(b, room, min(overlap, least - 1), least)):
                    piece = (h + "\n" if h else "") + b[start:end]
                    rows.append((k, no, first, n, start, end, kept, *([piece] if with_text else [])))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])

    picked = oversized.select(F.col(key).cast("string").alias("_key"), head.alias("_head"), body.alias("_body"))
    rows = picked.mapInPandas(split, schema)
    return rows.select(F.col("_key").cast(items.schema[key].dataType).alias(key), *rows.columns[1:])
