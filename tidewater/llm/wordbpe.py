"""Word-level BPE of a ``tokenizers`` file (NFC, lower case, word-end suffix): exact token
counts by heap-and-linked-list merging, and cached ids.

A text is cut into the pieces of the pre-tokenizer's pattern and each distinct piece is handled
once per worker.  Where characters occur whose class or case mapping could differ between
Unicode versions, the library's own normalizer and pre-tokenizer cut the white-space-delimited
chunk that holds them: no piece and no composition crosses ASCII white space.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np

_CHUNK = re.compile(r"[^ \t\n\r]+")
#: Not in this set: characters that are in NFC, have one-to-one lower case and undisputed classes.
ODD = re.compile("[^\t\n\r -~\u00a1-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u012f\u0131-\u024f\u0391-\u03a1\u03b1-\u03c9"
                 "\u0410-\u044f\u2010-\u2027\u2030-\u205e\u20ac\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")
#: The pre-tokenizer's pattern over lower-case text without odd characters.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Longest string kept in a cache, and most entries of one.
KEY_CHARS, CACHE_ENTRIES = 48, 700_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def count_after_merges(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Number of symbols left after merging: the adjacent pair of lowest rank (leftmost among
    equals) is popped from a heap and joined in a doubly linked list until none is left.  The
    count is the number of symbols at the start minus the merges; no ids are emitted."""
    n = len(symbols)
    if n < 2:
        return n
    sym, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(found[0], i, found[1]) for i in range(n - 1) if (found := pairs.get((sym[i], sym[i + 1])))]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i, joined = heapq.heappop(heap)
        j = after[i]
        if sym[i] < 0 or j >= n:
            continue
        now = pairs.get((sym[i], sym[j]))
        if now is None or now[0] != rank:  # the pair has changed since it was pushed
            continue
        sym[i], sym[j] = joined, -1
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if found := pairs.get((joined, sym[k])):
                heapq.heappush(heap, (found[0], i, found[1]))
        if (h := before[i]) >= 0 and (found := pairs.get((sym[h], joined))):
            heapq.heappush(heap, (found[0], h, found[1]))
    return n - merges


class _Cache(dict):
    """Values by string; short strings stay, up to a bound."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if isinstance(key, int) or len(key) <= KEY_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[key] = value
        return value


class WordVocabulary:
    """One vocabulary file; pieces of texts as strings, special strings as their ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.chars = byte_chars()
        self.of_char = {c: b for b, c in enumerate(self.chars)}
        self.specials = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")

    def pieces(self, text: str) -> list[str | int]:
        if "<" not in text:
            return self.plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self.plain(text[at:m.start()]), self.specials[m.group()]]
            at = m.end()
        return out + self.plain(text[at:])

    def plain(self, s: str) -> list[str]:
        if not ODD.search(s):
            return _PIECE.findall(s.lower())
        lib, out = self.library, []
        for chunk in _CHUNK.findall(s):
            if not ODD.search(chunk):
                out += _PIECE.findall(chunk.lower())
            else:
                cut = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(chunk))
                out += [bytes(map(self.of_char.__getitem__, p)).decode("utf-8", "surrogateescape") for p, _ in cut]
        return out

    @staticmethod
    def raw(piece: str) -> bytes:
        return piece.encode("utf-8", "surrogateescape")


class WordCounter(WordVocabulary):
    """Token counts of texts under one vocabulary file, by merging."""

    def __init__(self, path: str):
        super().__init__(path)
        model = self.spec.pop("model")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.inner = [vocab[c] for c in self.chars]
        self.last = [vocab[c + suffix] for c in self.chars]
        self.pairs = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.counts = _Cache(self.of_piece)

    def of_piece(self, piece: str | int) -> int:
        if isinstance(piece, int):
            return 1
        raw = self.raw(piece)
        return count_after_merges([*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]], self.pairs)

    def count(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self.pieces(text)))


class WordEncoder(WordVocabulary):
    """Ids of texts as the library gives them, as little-endian 32-bit integers; the library's
    model encodes each distinct piece once."""

    def __init__(self, path: str):
        super().__init__(path)
        del self.spec["model"]
        self.model = self.library.model
        self.ids = _Cache(self.of_piece)

    def of_piece(self, piece: str | int) -> bytes:
        ids = [piece] if isinstance(piece, int) else [
            t.id for t in self.model.tokenize("".join(map(self.chars.__getitem__, self.raw(piece))))]
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.ids.__getitem__, self.pieces(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
