"""Links in streamed answers: a mark may be cut by the end of a chunk, so the tail is kept as state."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

MARK = re.compile(r"\[REF:(\d+)\]")
# Fixed value: what a mark begins with.
OPENING = "[REF:"
OUT = "response_id string, seq bigint, text string"


def linked(text: str, refs: dict[int, tuple[str, int]]) -> str:
    """Known marks as links; unknown ones stand."""
    def link(m: re.Match) -> str:
        ref = refs.get(int(m.group(1)))
        return m.group() if ref is None else f'<a href="https://docs.local/files/{ref[0]}#page={ref[1]}">[{m.group(1)}]</a>'

    return MARK.sub(link, text)


def split_tail(text: str) -> tuple[str, str]:
    """Text that is complete, and the start of a mark at its end: what follows the last bracket, if a mark can still come of it."""
    at = text.rfind("[")
    tail = text[at:] if at >= 0 else ""
    may_become = OPENING.startswith(tail) or (tail.startswith(OPENING) and tail[len(OPENING) :].isdigit())
    return (text[:at], tail) if tail and may_become else (text, "")


def stream_links(chunks: DataFrame, refs: dict[int, tuple[str, int]], timeout_ms: int = 60_000) -> DataFrame:
    """(response_id, seq, text) of a stream of chunks (response_id, seq, text, is_last), in the order of ``seq`` within a batch.

    The state of a response is the tail of its last chunk, a few characters; it is flushed with the last chunk or after the timeout."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            tail, seq = state.get
            state.remove()
            yield pd.DataFrame([(key[0], seq + 1, linked(tail, refs))], columns=["response_id", "seq", "text"])
            return
        tail, seq = state.get if state.exists else ("", -1)
        rows = pd.concat(list(frames)).sort_values("seq")
        out, ended = [], False
        for n, text, last in zip(rows["seq"], rows["text"], rows["is_last"], strict=True):
            whole, tail = split_tail(tail + (text or ""))
            if last:
                whole, tail, ended = whole + tail, "", True
            seq = int(n)
            out.append((key[0], seq, linked(whole, refs)))
        if ended:
            state.remove()
        else:
            state.update((tail, seq))
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=["response_id", "seq", "text"])

    return chunks.groupBy("response_id").applyInPandasWithState(step, OUT, "tail string, seq bigint", "append", GroupStateTimeout.ProcessingTimeTimeout)


def events(chunks: DataFrame, key: str = "response_id") -> DataFrame:
    """(key, seq, event, data) of answers' chunks (key, seq, text, is_last, error) as server-sent events: a ``chunk`` for each text, ``result`` with the last one,
    ``error`` where a chunk has a message. Chunks without text, unless they are the last, are left out."""
    kind = F.when(F.coalesce("error", F.lit("")) != "", "error").when(F.col("is_last"), "result").otherwise("chunk")
    body = F.when(kind == "error", F.to_json(F.struct(F.col("error").alias("message")))).otherwise(F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"))))
    shown = chunks.where((F.coalesce("text", F.lit("")) != "") | F.col("is_last") | (F.coalesce("error", F.lit("")) != ""))
    return shown.select(key, "seq", kind.alias("event"), F.concat(F.lit("event: "), kind, F.lit("\ndata: "), body, F.lit("\n\n")).alias("data"))
