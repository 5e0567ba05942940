"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

The tree's root is the lowest rank, leftmost among equals, so each merge costs a descent-free lookup and two
logarithmic point updates. Text is cut into whitespace-led pieces first: a boundary between a non-space and a space
character is always a boundary of the splitting pattern, so pieces are independent and may be memoised.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import re
import struct

import regex

#: The splitting pattern of the byte-level vocabularies, and Unicode's White_Space characters.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_SPLIT = regex.compile(SPLIT_PATTERN)
_PIECES = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
_DEAD = 1 << 62

DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"
#: A worker's memo is emptied at this many pieces, and longer pieces are never kept.
MEMO_PIECES = 200_000
MEMO_LENGTH = 48


def vocabulary_path(name: str = DEFAULT_VOCABULARY, folder: str | None = None) -> str:
    """Path of a vocabulary file: below ``folder``, else ``$TOKENIZER_DIR``, else the installed package of tokenizers."""
    folder = folder or os.environ.get("TOKENIZER_DIR")
    if folder is None:
        spec = importlib.util.find_spec("public_tokenizers")
        if spec is None or spec.origin is None:
            raise FileNotFoundError("no folder of tokenizers given")
        folder = os.path.dirname(spec.origin)
    return os.path.join(folder, name)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece.

    Leaf i holds the key of the pair that starts at byte i, ``rank * 2**32 + i``; inner nodes hold the least key.
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    if n == 0:
        return []
    get = ranks.get
    size = 1
    while size < n:
        size <<= 1
    tree = [_DEAD] * (2 * size)
    for i in range(n - 1):
        rank = get(word[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << 32 | i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def put(i: int, key: int) -> None:
        node = size + i
        tree[node] = key
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    def pair(i: int) -> int:
        middle = end[i]
        if middle >= n:
            return _DEAD
        rank = get(word[i : end[middle]])
        return _DEAD if rank is None else rank << 32 | i

    while tree[1] != _DEAD:
        i = tree[1] & 0xFFFFFFFF
        gone = end[i]
        end[i] = end[gone]
        if end[i] < n:
            before[end[i]] = i
        put(gone, _DEAD)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    ids = []
    i = 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


class _Memo(dict):
    """Piece of text -> value, made on demand; bounded."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str):
        value = self.make(piece)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = value
        return value


class Encoder:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self._words = _Memo(self._merge)
        self._packed = _Memo(self._pack)
        self._counts = _Memo(self._count)

    def _merge(self, word: str) -> list[int]:
        return merge_bytes(word.encode(), self.ranks)

    def _piece(self, piece: str) -> list[int]:
        words = _SPLIT.findall(piece)
        if len(words) == 1:
            return self._merge(piece)
        return [i for word in words for i in self._words[word]]

    def _pack(self, piece: str) -> bytes:
        ids = self._piece(piece)
        return struct.pack(f"<{len(ids)}i", *ids)

    def _count(self, piece: str) -> int:
        return len(self._piece(piece))

    def packed(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian 32-bit integers."""
        return b"".join(map(self._packed.__getitem__, _PIECES.findall(text)))

    def encode(self, text: str) -> list[int]:
        packed = self.packed(text)
        return list(struct.unpack(f"<{len(packed) // 4}i", packed))

    def count(self, text: str) -> int:
        """Number of tokens of ``text``."""
        return sum(map(self._counts.__getitem__, _PIECES.findall(text)))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, one for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_SAFE = re.compile(f"[^{WHITE_SPACE}](?=[{WHITE_SPACE}])")
_CLASS_CHANGE = regex.compile(r"\p{L}(?=[^\p{L}'\s])|\p{N}(?=[^\p{N}'\s])")


def independent_chunks(text: str, limit: int) -> list[str]:
    """Cut ``text`` into chunks of about ``limit`` characters whose tokens are, put together, those of the whole text.

    A cut is proven where a non-space character is followed by white space, or a letter or digit by a character of
    another class but apostrophes: no alternative of the splitting pattern reaches across, and none looks back. The
    letter after which is cut may be that of a contraction ('s), after which any word ends too. A text without such a
    place stays whole from there on.
    """
    if len(text) <= limit:
        return [text]
    chunks, start = [], 0
    while len(text) - start > limit:
        found = _SAFE.search(text, start + limit - 1)
        other = _CLASS_CHANGE.search(text, start + limit - 1, found.end() if found else len(text))
        if other is not None and (found is None or other.end() < found.end()):
            found = other
        if found is None or found.end() >= len(text):
            break
        chunks.append(text[start : found.end()])
        start = found.end()
    chunks.append(text[start:])
    return chunks
