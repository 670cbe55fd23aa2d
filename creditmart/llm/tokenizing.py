"""Token ids of whole texts with a public byte-level vocabulary.

The vocabulary comes in two forms with the same ids; the form with ranks is read
here because its encoder is about four times as fast. Tests hold one against the other.
Only the JSON form has the added tokens, which stand for their strings wherever a text has them.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import public_tokenizers
import tiktoken

RANKS = "byte_bpe_50k.tiktoken"
ADDED = "byte_bpe_50k.json"


def encoder(ranks_path: str | None = None, added: bool = False) -> tiktoken.Encoding:
    """The vocabulary's encoder; ``ranks_path`` is a file of tokens and their ranks.

    Without ``added`` no string is special: those of special tokens are ordinary text.
    """
    with open(ranks_path or public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = added_tokens() if added else {}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def added_tokens() -> dict[str, int]:
    """Strings that the vocabulary's JSON form takes whole, and their ids."""
    with open(public_tokenizers.path(ADDED), encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}


def token_ids(text: str, coder: tiktoken.Encoding) -> np.ndarray:
    """Ids of a text, with those of the coder's added tokens, as little-endian unsigned 32-bit numbers."""
    return np.array(coder.encode(text, allowed_special="all"), dtype="<u4")
