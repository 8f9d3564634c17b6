"""Token ids of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from .rows import blocks

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


class ByteBpe:
    """Encoder and decoder of a tokenizer file with a file of the same vocabulary as ranks beside it.

    The ranks give the same ids several times faster. Texts that hold an added
    token's string, which the tokenizer does not split, go to the tokenizer.
    """

    def __init__(self, path: str = BYTE_BPE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path = path
        self.full = Tokenizer.from_file(path)
        self.added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text with added tokens recognised, as the tokenizer gives them."""
        if any(token in text for token in self.added):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.encode_ordinary(text)

    def encode_ordinary(self, text: str) -> np.ndarray:
        """Ids of a text in which added tokens are ordinary text."""
        parts = [np.array(self.fast.encode_ordinary(part), dtype="<u4") for part in blocks(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def decode(self, ids) -> str:
        return self.fast.decode_bytes([int(i) for i in ids]).decode("utf-8", "surrogatepass")
