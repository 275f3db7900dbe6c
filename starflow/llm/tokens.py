"""Byte-level BPE encoding inside tasks.

The vocabulary files are found by :func:`public_tokenizers.path` in every Python worker. The same
vocabulary is there twice: as a file of the ``tokenizers`` library and as ranks, from which the
``tiktoken`` library gives the same ids faster and without a cache. Texts that hold the string of an
added token, or a run of more than ``LONG_RUN`` characters between blanks, go to the former (tests
compare both on whole texts).
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
LONG_RUN = 2_000


def _byte_chars() -> dict[int, str]:
    """Byte -> character of byte-level BPE: printable bytes stand for themselves, the others
    follow from U+0100 in ascending order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Encoder:
    """Encode texts to little-endian unsigned 32-bit ids, as bytes. ``special_as_text``: the
    strings of added tokens (``<|endoftext|>``) in a text are ordinary text; otherwise they get the
    ids of those tokens, as the library gives them by itself."""

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str | None = RANKS, special_as_text: bool = True):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = () if special_as_text else tuple(
            t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.fast = None
        if ranks is None:  # no ranks of this vocabulary: the library encodes everything
            return
        with open(public_tokenizers.path(ranks), "rb") as f:
            merges = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        """Ids of a text (null: none)."""
        if not text:
            return b""
        if self.fast is None or any(t in text for t in self.special) or max(map(len, text.split()), default=0) > LONG_RUN:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.fast.encode_ordinary(text)).tobytes()


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """One encoder per Python worker, with the ids of the library's plain call."""
    return Encoder(vocabulary, RANKS if vocabulary == VOCABULARY else None, special_as_text=False)
