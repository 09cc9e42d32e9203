"""Token ids of whole texts with a public byte-level BPE vocabulary.

Two files hold the same vocabulary, one for each of two libraries.
``tokenizers`` defines the ids. ``tiktoken`` is several times as fast and
gives the same ids where both agree on what a letter and a space is, so it
encodes texts of plain Latin characters; ``tokenizers`` encodes every other
text, those with a special token in them, and those with very long white
space, which ``tiktoken`` cannot take.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Characters on which the libraries might differ: controls, odd spaces, all beyond Latin.
_ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]")

#: A run of white space from which on ``tiktoken`` is not asked (it ends the process at a million).
LONG_SPACE = 10_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")


def default_paths() -> tuple[str, str]:
    """The vocabulary for ``tokenizers`` and the same as ranks for ``tiktoken``."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Encodes texts to little-endian ids of the narrowest width, as bytes."""

    def __init__(self, json_path: str, ranks_path: str) -> None:
        self._tokenizer = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary
        narrow = self._tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self._code = np.dtype("<u2" if narrow else "<u4"), "H" if narrow else "I"
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        if (_ODD.search(text) or any(s in text for s in self._special)
                or (len(text) >= LONG_SPACE and _LONG_SPACE.search(text))):
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self._fast(text)
        return array(self._code, ids).tobytes()


@lru_cache(maxsize=2)
def encoder(json_path: str, ranks_path: str) -> Encoder:
    return Encoder(json_path, ranks_path)
