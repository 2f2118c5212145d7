"""Token ids of a byte-level BPE vocabulary, by the faster of two libraries with the same result."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

#: The vocabulary's pre-tokenising pattern, its special token and their files' names.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where this machine has a public tokenizer's file; every machine has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteBpe:
    """Ids of texts. ``path`` names the JSON vocabulary; its ranks lie beside it."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        ranks_path = os.path.join(os.path.dirname(path), RANKS)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(path)

    def ids(self, text: str) -> np.ndarray:
        """Ids without added special tokens. The special token's own string keeps its id, as the vocabulary
        file says, which only the slower library does; runs that the faster one gives up on go there too."""
        if SPECIAL not in text:
            try:
                return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
            except BaseException as error:
                if type(error).__name__ != "PanicException":
                    raise
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """One encoder for each file and Python worker."""
    return ByteBpe(path)
