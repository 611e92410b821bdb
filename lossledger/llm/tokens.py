"""Token ids of whole texts by a public word-level BPE file, quickly and in bounded memory.

White space always separates tokens in this vocabulary, so a text is cut at white space and each piece's ids are
remembered, up to a bound after which the memory starts anew. Pieces of plain letters go through a byte-pair merge over
the same merge ranks; everything else (marks, digits, other scripts, spellings of special tokens) goes to the file's own
tokenizer, which the tests hold both ways against.
"""

from __future__ import annotations

import json
import re
from array import array

import regex

REMEMBERED = 300_000
#: Control characters that Python takes for white space and the vocabulary does not.
_ODD = re.compile("[\x1c-\x1f]")
#: Fixed value: how the vocabulary cuts lower-case text.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = "İ"


def vocabulary_path(path: str | None = None) -> str:
    """The vocabulary file; by default the installed public one."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _letter_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Merge ranks over bytes in which a word's last byte has a code of its own: A-Z stands for a last a-z, 0-63 for a
    last continuation byte. Lower-case words of letters use neither otherwise."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable}
    shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    ranks = {bytes([b]): -1 - b for b in range(256)}
    for token, rank in vocabulary.items():
        last = token.endswith("</w>")
        codes = [shown.get(c) for c in (token[:-4] if last else token)]
        if not codes or None in codes or any(b < 0x80 and not 0x61 <= b <= 0x7A for b in codes):
            continue
        if last:
            if codes[-1] >= 0xC0:  # no character ends in such a byte
                continue
            codes[-1] -= 0x20 if codes[-1] < 0x80 else 0x80
        ranks[bytes(codes)] = rank
    free = max(ranks.values()) + 1
    for b in range(256):  # the merge needs a rank for each byte; these never come out
        if ranks[bytes([b])] < 0:
            ranks[bytes([b])] = free + b
    return ranks


class PackedIds(dict):
    """White-space-free piece of text -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, special_as_text: bool = False, remembered: int = REMEMBERED):
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        self._full = Tokenizer.from_file(path)
        self._full.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            ranks = _letter_ranks(json.load(f)["model"]["vocab"])
        self._merge = tiktoken.Encoding("letters", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self._words: dict[str, bytes] = {}
        self._most = remembered

    def _pack(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha() and max(word) < _PLAIN:
            code = bytearray(word.encode())
            code[-1] = code[-1] - 0x20 if code[-1] < 0x80 else code[-1] - 0x80
            got = self._pack(self._merge(bytes(code)))
        else:
            got = self._pack(self._full.encode(word, add_special_tokens=False).ids)
        if len(self._words) >= self._most:
            self._words.clear()
        self._words[word] = got
        return got

    def __missing__(self, piece: str) -> bytes:
        if max(piece) < _PLAIN and "<|" not in piece:
            words = self._words
            got = b"".join([words.get(w) or self._word(w) for w in _PIECES.findall(piece.lower())])
        else:
            got = self._pack(self._full.encode(piece, add_special_tokens=False).ids)
        if len(self) >= self._most:
            self.clear()
        self[piece] = got
        return got

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _ODD.search(text):
            return self._pack(self._full.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.split()))


_kept: dict[tuple, PackedIds] = {}


def packed_ids(path: str, special_as_text: bool = False) -> PackedIds:
    """One per worker process, kept between its tasks."""
    key = (path, special_as_text)
    if key not in _kept:
        _kept[key] = PackedIds(*key)
    return _kept[key]
