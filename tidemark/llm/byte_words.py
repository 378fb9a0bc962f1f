"""Byte-level BPE ids of whole texts, pre-token by pre-token from a worker's cache.

The vocabulary's own pattern parts a text into pre-tokens, and no merge crosses
from one into the next, so the ids of a text are those of its pre-tokens. Texts of
the first Unicode blocks with common punctuation are parted by an equal pattern of
the standard library; any other text is left to the joining library as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

from tidemark.llm.bpe import byte_letters, ranked
from tidemark.llm.rows import Memory

#: Pre-tokens in each of a worker's two generations.
CACHED = 300_000

#: Letters and digits of the texts that are parted here; other texts are not.
LETTER = "a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t\n\r "
_PRE_TOKENS = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: What such a text may not hold: spaces and letters of other kinds.
OTHER_TEXT = re.compile(
    "[^\x00-ɏ‐-‧‰-⁞€]|[\x0b\x0c\x1c-\x1f\x85\xa0\xaa\xb5\xba]"
)


#: The bytes of ASCII that need no second look.
_PLAIN_BYTES = bytes(b for b in range(128) if not OTHER_TEXT.search(chr(b)))


def is_plain(text: str) -> bool:
    """Whether the text holds only what ``OTHER_TEXT`` allows."""
    left = text.encode().translate(None, _PLAIN_BYTES)
    return not left or not OTHER_TEXT.search(left.decode())


class ByteWords:
    """Little-endian 32-bit ids of texts."""

    def __init__(self, path: str, cached: int = CACHED):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        letters = byte_letters()
        vocabulary = stated["model"]["vocab"]
        self.tokens = {i: bytes(letters[x] for x in token) for token, i in vocabulary.items()}
        special = {x["content"]: x["id"] for x in stated["added_tokens"]}
        self._special = {s: array("I", [i]).tobytes() for s, i in special.items()}
        self._parted = re.compile("|".join(map(re.escape, special))) if special else None
        self._ranked = ranked(stated["model"], letters)
        self._ids = Memory(lambda units: map(self.join, units), cached)

    def ids_of(self, text: str) -> list[int]:
        """Ids of a text by the library, special strings as plain text."""
        return self._ranked.encode_ordinary(text)

    def join(self, text: str) -> bytes:
        return array("I", self.ids_of(text)).tobytes()

    def plain(self, text: str) -> bytes:
        """Ids of a text whose special strings are plain text."""
        if not is_plain(text):
            return self.join(text)
        return b"".join(map(self._ids.__getitem__, _PRE_TOKENS.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a text whose special strings are special tokens."""
        if self._parted is None or not self._parted.search(text):
            return self.plain(text)
        out, at = [], 0
        for match in self._parted.finditer(text):
            out += [self.plain(text[at : match.start()]), self._special[match.group()]]
            at = match.end()
        return b"".join([*out, self.plain(text[at:])])


@lru_cache(maxsize=2)
def byte_words(path: str) -> ByteWords:
    """One per worker and vocabulary, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteWords(path)
