"""Public tokenizers, read from a folder that the machine provides."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

FOLDER = "/opt/tokenizers"
NAME = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def byte_bpe(folder: str = FOLDER, name: str = NAME):
    """The byte-level tokenizer, loaded once in each worker."""
    import tiktoken

    with open(os.path.join(folder, name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
