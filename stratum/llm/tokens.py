"""Public tokenizers inside tasks. Vocabulary files are read from a path given as a parameter."""

from __future__ import annotations

import base64
import re
from array import array

import numpy as np

#: Tokens remembered by a worker before a new generation begins (two are held); results don't depend on it.
MEMO_LIMIT = 150_000

# Split pattern of the word BPE for texts of Latin-1 letters only, where these classes equal \p{L} and \p{N}.
_LATIN = re.compile(r"[\x21-\x7e\xa1-\xff]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-z0-9ªµºß-öø-ÿ²³¹¼½¾]+")
# str.split() also splits at these, which the tokenizer takes for symbols.
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


# Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}


class _Tokens(dict):
    """Ids of each white-space token, and of pieces of tokens; what is not known yet is encoded.

    A piece is a token too, with the same ids. Two generations: what the one before knows is taken over when it is met again.
    """

    def __init__(self, whole, model, before: dict | None = None):
        super().__init__()
        self._whole, self._model, self._before = whole, model, before or {}

    def next(self) -> _Tokens:
        """The generation after this one; the one before goes."""
        self._before = {}
        return _Tokens(self._whole, self._model, self)

    def _piece(self, piece: str) -> bytes:
        """Ids of one lower-case Latin-1 piece: the byte-level form of it goes straight to the merges."""
        got = self._before.get(piece)
        if got is None:
            form = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LEVEL)
            got = array("I", [x.id for x in self._model.tokenize(form)]).tobytes()
        self[piece] = got
        return got

    def __missing__(self, t: str) -> bytes:
        got = self._before.get(t)
        if got is not None:
            self[t] = got
            return got
        known, new = self.get, self._piece
        plain = t.isascii() or max(t) <= "ÿ"
        if plain and t.isalpha():
            t_low = t.lower()
            got = known(t_low) or new(t_low)
        elif plain and t[-1] in ".," and t[:-1].isalpha():
            t_low = t[:-1].lower()
            got = (known(t_low) or new(t_low)) + (known(t[-1]) or new(t[-1]))
        elif plain and "<|" not in t and _LATIN.fullmatch(t):
            got = b"".join([known(p) or new(p) for p in _PIECES.findall(t.lower())])
        else:
            got = self._whole(t)
        self[t] = got
        return got


class WordTokenizer:
    """Ids of a lower-casing word BPE (``tokenizers`` file): white-space tokens are encoded once and remembered,
    and so are their pieces.

    The file's splitter never joins across white space, so a text's ids are its tokens' ids in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._t = Tokenizer.from_file(path)
        self._tokens = _Tokens(self._whole, self._t.model)

    def _whole(self, text: str) -> bytes:
        return np.array(self._t.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text, as bytes."""
        if any(map(text.__contains__, _ODD_SPACE)):
            return self._whole(text)
        if len(self._tokens) > MEMO_LIMIT:
            self._tokens = self._tokens.next()
        return b"".join(map(self._tokens.__getitem__, text.split()))


class ByteTokenizer:
    """Byte-level BPE (``tiktoken`` ranks file) that also knows where each token lies."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._e = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the whole text, and the byte at which each ends in its UTF-8 form."""
        ids = np.array(self._e.encode_ordinary(text), dtype=np.int64)
        return ids, np.cumsum(self._bytes[ids])


_CACHE: dict[tuple, object] = {}


def forget() -> None:
    """Let this worker's tokenizers go."""
    _CACHE.clear()


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    key = ("word", path)
    if key not in _CACHE:
        _CACHE[key] = WordTokenizer(path)
    return _CACHE[key]


def byte_tokenizer(path: str, pattern: str) -> ByteTokenizer:
    key = ("byte", path, pattern)
    if key not in _CACHE:
        _CACHE[key] = ByteTokenizer(path, pattern)
    return _CACHE[key]
