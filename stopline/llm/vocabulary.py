"""Token lengths and ids of pre-tokens, looked up before they are encoded.

White space splits almost every text into pieces whose tokens do not depend on their neighbours, so
a piece is encoded once and then looked up. A text goes piece by piece only if that provably gives
the library's result: all its characters are in a set on which letter classes, white space, case
and normalisation are settled, and it holds no special string. Any other text is encoded whole.
"""

from __future__ import annotations

import os
import re

CACHE_ENTRIES = 400_000
LONGEST_KEPT = 64

# The published pre-token patterns of the two vocabularies.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# tab, line feed, carriage return, printable ASCII, Latin letters up to U+017E without the dotted
# capital I, general punctuation without the separators, and the euro sign
UNSETTLED = re.compile("[^\t\n\r\x20-\x7e¡-¬®-įı-ž‐-‧‰-⁞€]")
SPACE_RUN = re.compile(r" [ \t\n\r]")


def tokenizer_path(name: str) -> str:
    """Where the vocabulary file lies on this machine; every worker has its own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """The library's tokenizer, one thread, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def plain(self, text: str) -> bool:
        """Whether the text may be taken piece by piece."""
        return not UNSETTLED.search(text) and not any(s in text for s in self.specials)


class Bounded(dict):
    """A cache that starts anew when it is full and never keeps very long keys."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value
