"""Byte-level BPE encoding and decoding by forced boundaries.

A pair of adjacent bytes that occurs inside no token of the vocabulary can never
be joined: a cut there is certain. A text is cut at all such pairs, each fragment
is encoded on its own, and the ids are put together. Fragments repeat (they are
mostly words), so a bounded cache in each worker answers nearly all of them.

Three kinds of certain cuts are not used, since the pattern that splits a text
before the merges looks around them: behind white space (a run of it is split by
what follows), before an apostrophe unless a letter or digit of ASCII stands
before it (``'s`` and the like), and inside a character of several bytes.
Special tokens are found first, as the library does, and split the text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.rows import map_texts

#: Fragments a worker remembers.
CACHED = 200_000

#: The pattern of byte-level pre-tokenizers, a fixed value.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_ASCII_SPACE = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_WIDE_SPACE = re.compile("[\x85\xa0  -     　]")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, to that byte.

    Printable bytes stand for themselves; the others take the letters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def forced_cuts(tokens: list[bytes]) -> np.ndarray:
    """For each pair of bytes (first * 256 + second): is a cut between them certain and used?"""
    cut = np.ones((256, 256), bool)
    for token in tokens:
        codes = np.frombuffer(token, np.uint8)
        cut[codes[:-1], codes[1:]] = False
    cut[list(_ASCII_SPACE), :] = False
    cut[:, 0x80:0xC0] = False
    alphanumeric = [b for b in range(128) if chr(b).isalnum()]
    apostrophe = cut[alphanumeric, ord("'")]
    cut[:, ord("'")] = False
    cut[alphanumeric, ord("'")] = apostrophe
    return cut.reshape(-1)


def ranked(model: dict, letters: dict[str, int]):
    """The same vocabulary for the library that joins by rank; it is faster on short texts.

    That is exact if merges are numbered in the order in which they apply.
    """
    import tiktoken

    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split())] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        raise ValueError("merges are not numbered in the order in which they apply")
    ranks = {bytes(letters[x] for x in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding(
        "fragments", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


class Codec:
    """Encodes texts to little-endian 32-bit ids and decodes them."""

    def __init__(self, path: str, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        letters = byte_letters()
        self.tokens = {
            i: bytes(letters[x] for x in token) for token, i in stated["model"]["vocab"].items()
        }
        self.cut = forced_cuts(list(self.tokens.values()))
        special = {x["content"]: x["id"] for x in stated["added_tokens"]}
        self.tokens |= {i: text.encode() for text, i in special.items()}
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self._ranked = ranked(stated["model"], letters)
        self._cached, self._ids = cached, {}

    def fragments(self, data: bytes) -> list[bytes]:
        """``data`` cut at every forced boundary."""
        codes = np.frombuffer(data, np.uint8)
        pairs = codes[:-1].astype(np.uint16) << 8
        pairs |= codes[1:]
        at = (np.flatnonzero(self.cut[pairs]) + 1).tolist()
        return [data[i:j] for i, j in zip([0, *at], [*at, len(data)])]

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if _WIDE_SPACE.search(text):  # its last byte looks like that of a letter
            cuts = [m.end() for m in _WIDE_SPACE.finditer(text)]
            return self._around(text, cuts)
        return self._joined(self.fragments(text.encode()))

    def _around(self, text: str, spaces: list[int]) -> bytes:
        """As ``_plain``, with no cut at the given ends of wide white space."""
        data = text.encode()
        barred = {len(text[:i].encode()) for i in spaces}
        parts, at, held = [], 0, b""
        for part in self.fragments(data):
            at += len(part)
            held += part
            if at not in barred:
                parts.append(held)
                held = b""
        return self._joined([*parts, held] if held else parts)

    def _joined(self, parts: list[bytes]) -> bytes:
        try:
            return b"".join(map(self._ids.__getitem__, parts))
        except KeyError:
            self._learn(set(parts))
            return b"".join(map(self._ids.__getitem__, parts))

    def _learn(self, parts: set[bytes]) -> None:
        """Put the ids of fragments into the cache, which is bounded."""
        new = parts.difference(self._ids)
        if len(self._ids) + len(new) > self._cached:
            self._ids.clear()
            new = parts
        encode = self._ranked.encode_ordinary
        found = [encode(part.decode()) for part in new]
        ends = np.cumsum([4 * len(ids) for ids in found]).tolist()
        ids = np.array(list(chain.from_iterable(found)), "<u4").tobytes()
        self._ids.update((part, ids[i:j]) for part, i, j in zip(new, [0, *ends], ends))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special is None or not (found := list(self.special.finditer(text))):
            return self._plain(text)
        out, at = [], 0
        for match in found:
            if at < match.start():
                out.append(self._plain(text[at : match.start()]))
            out.append(self._whole(match.group()))
            at = match.end()
        if at < len(text):
            out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text of the ids in UTF-8; bytes that are none become U+FFFD."""
        data = b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode(errors="replace").encode()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids (array) and the text they decode to, for each row of ``docs``.

    Null and empty texts give no ids and an empty text; repeated rows give one
    result each; no rows give no rows.
    """

    def start():
        held = codec(path)

        def work(texts):
            ids = [held.encode(text) for text in texts]
            yield [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
            yield [held.decode(x).decode() for x in ids]

        return work

    return map_texts(docs, start, "ids array<int>, decoded string", id_col, text_col)


def digest_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 for each row of ``docs``.

    As ``encode_documents``, with the digests taken in the worker, so that no ids
    travel: of the ids as little-endian unsigned 32-bit numbers, and of the text
    they decode to in UTF-8.
    """

    def start():
        held = codec(path)

        def work(texts):
            ids = [held.encode(text) for text in texts]
            yield [len(x) // 4 for x in ids]
            yield [hashlib.sha256(x).hexdigest() for x in ids]
            yield [hashlib.sha256(held.decode(x)).hexdigest() for x in ids]

        return work

    return map_texts(
        docs, start, "n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col
    )
