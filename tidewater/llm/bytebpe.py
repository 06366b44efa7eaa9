"""Byte-level BPE by prefix-sharing trie traversal, and decoding (operator 5).

For a vocabulary built by merging, the encoding of a word is the one token sequence in which
every two neighbours stay apart when they are merged on their own, and cutting its last token off
leaves the encoding of the shorter prefix.  So every prefix of every word has one *last token*.
The distinct words of a batch go into a trie; a depth-first walk sets each node's last token from
those of its ancestors, and a prefix shared by many words is encoded once.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import map_batches, pick
from tidewater.llm.wordbpe import CACHE_ENTRIES, KEY_CHARS, ODD, byte_chars

#: The byte-level pre-tokenizer's pattern (fixed by the file format), for texts without odd characters.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class TrieEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        of_char = {c: b for b, c in enumerate(byte_chars())}
        raw = lambda s: bytes(map(of_char.__getitem__, s))
        self.raw = raw
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.vocab = vocab = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in self.specials}
        self.bytes_of = {i: b for b, i in vocab.items()} | {i: s.encode() for s, i in self.specials.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for k, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            a, b = raw(a), raw(b)
            self.rank.setdefault((vocab[a], vocab[b]), (k, vocab[a + b]))
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        #: Only tokens that their own bytes are merged into can occur.
        self.vocab = {b: i for b, i in vocab.items() if self.merged(b) == [i]}
        #: Longest token with a given ending of three bytes.
        self.reach: dict[bytes, int] = {}
        for b in self.vocab:
            if len(b) > 2:
                self.reach[b[-3:]] = max(len(b), self.reach.get(b[-3:], 0))
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str | int, bytes] = {}
        self.texts: dict[bytes, bytes] = {}

    def merged(self, raw: bytes) -> list[int]:
        """Reference merging of a short string, used to judge single tokens and pairs."""
        ids = [self.vocab[raw[i:i + 1]] for i in range(len(raw))]
        while len(ids) > 1:
            best = min((f[0], i, f[1]) if (f := self.rank.get((ids[i], ids[i + 1]))) else (1 << 60, i, 0)
                       for i in range(len(ids) - 1))
            if best[0] == 1 << 60:
                break
            ids[best[1]:best[1] + 2] = [best[2]]
        return ids

    def apart(self, left: int, right: int) -> bool:
        """Whether the two tokens, merged as one string, give themselves again."""
        out = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        if len(self.fits) >= CACHE_ENTRIES:
            self.fits.clear()
        self.fits[left, right] = out
        return out

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Encodings of distinct words.  The trie's nodes are visited depth first in byte order,
        which is the order of the sorted words; the stack of last tokens holds the path.  The
        last token of a prefix is the one that ends there and stays apart from the last token of
        what is before it."""
        token_of, reach, fits, apart = self.vocab.get, self.reach.get, self.fits, self.apart
        out, path, last, starts = {}, b"", [-1], [0]
        for raw, word in sorted((w.encode("utf-8", "surrogateescape"), w) for w in words):
            shared = len(commonprefix((path, raw)))
            del last[shared + 1:], starts[shared + 1:]  # back up to the fork
            for n in range(shared + 1, len(raw) + 1):
                k = n - reach(raw[n - 3:n], 2) if n > 2 else 0
                for i in range(max(k, 0), n):
                    token = token_of(raw[i:n])
                    if token is not None:
                        if not i:
                            break
                        fit = fits.get((last[i], token))
                        if apart(last[i], token) if fit is None else fit:
                            break
                else:
                    raise ValueError("no token ends here; the vocabulary lacks single bytes")
                last.append(token)
                starts.append(i)
            path = raw
            ids, n = [], len(raw)
            while n:
                ids.append(last[n])
                n = starts[n]
            ids.reverse()
            out[word] = array("I", ids).tobytes()
        return out

    def pieces(self, text: str) -> list[str | int]:
        """Words of a text, special strings as their ids."""
        out: list[str | int] = []
        at = 0
        if "<" in text:
            for m in self.special.finditer(text):
                out += [*self.plain(text[at:m.start()]), self.specials[m.group()]]
                at = m.end()
        return out + self.plain(text[at:]) if at else out + self.plain(text)

    def plain(self, s: str) -> list[str]:
        if not ODD.search(s):
            return _PIECE.findall(s)
        return [s[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(s)] if s else []

    def round_trip(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids of the texts (little-endian 32-bit integers), and the texts decoded from the ids.
        Words, and the ids of words, that occur again are looked up."""
        cut = [self.pieces(t) for t in texts]
        new = {w for words in cut for w in words if w not in self.words}
        if len(self.words) + len(new) > CACHE_ENTRIES:
            self.words.clear()
            self.texts.clear()
            new = {w for words in cut for w in words}
        for i in [w for w in new if isinstance(w, int)]:
            new.discard(i)
            self.words[i] = array("I", [i]).tobytes()
            self.texts[self.words[i]] = self.bytes_of[i]
        for w, ids in self.encode_words(new).items():
            self.words[w] = ids
            self.texts[ids] = b"".join(map(self.bytes_of.__getitem__, array("I", ids)))
        ids = [[*map(self.words.__getitem__, words)] for words in cut]
        decoded = [b"".join(map(self.texts.__getitem__, x)).decode("utf-8", "replace") for x in ids]
        for w in new:
            if len(w) > KEY_CHARS:
                self.texts.pop(self.words.pop(w), None)
        return [b"".join(x) for x in ids], decoded


@lru_cache(maxsize=2)
def trie_encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def encode_decode(docs: DataFrame, tokenizer: str | None = None, digests: bool = False,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, then ``ids`` (array of int) and ``decoded`` (text decoded from
    the ids), or their SHA-256 digests ``ids_sha256`` and ``decoded_sha256``.

    One narrow pass over whole texts.  A null text counts as empty (no ids, empty decoded text),
    null ids of rows and repeated rows pass through, an empty table gives an empty result, other
    columns are ignored.  Special strings in a text become their ids, as the library does by
    default.
    """
    path = tokenizer or default_tokenizer()
    source = pick(docs, id_col, text_col)
    id_type = source.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = trie_encoder(path)
        for batch in batches:
            ids, decoded = enc.round_trip([t or "" for t in batch.column(1).to_pylist()])
            if digests:
                rest = [pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())]
            else:
                rest = [pa.array([np.frombuffer(i, dtype="<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())),
                        pa.array(decoded, pa.string())]
            names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), *rest],
                names=[id_col, "n_tokens", *names])

    kind = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return map_batches(source, run, f"`{id_col}` {id_type}, n_tokens bigint, {kind}")
