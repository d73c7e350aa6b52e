"""Word-wise encoding with a public BPE tokenizer whose pre-tokenizer never joins text across white space.

A text's ids are the ids of its white-space separated words one after the other, so each
distinct word is encoded once per worker and then looked up. The caches are bounded: when one
is full it is emptied.
"""

from __future__ import annotations

import unicodedata

import regex

MOST = 300_000  # words kept by a worker
_shared: dict[str, "WordTokenizer"] = {}


def _byte_characters() -> list[str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(256 + extra))
        extra += b not in plain
    return out


class WordTokenizer:
    # fixed value: the pre-tokenizer's own pattern
    PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    PLAIN = regex.compile(r"[\p{Latin}\p{N}\p{P}--İ]+", regex.V1)

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
        self.words: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.bytes = _byte_characters()

    @classmethod
    def shared(cls, name: str) -> "WordTokenizer":
        if name not in _shared:
            _shared[name] = cls(name)
        return _shared[name]

    def id_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        known = self.words
        words = text.replace("\n", " ").split(" ")
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        if len(known) > MOST:
            known.clear()
            known[""] = b""
        return b"".join([known[w] if w in known else self._word(w) for w in words])

    def _word(self, word: str) -> bytes:
        if "<|" not in word and (word.isascii() or self.PLAIN.fullmatch(word) and unicodedata.is_normalized("NFC", word)):
            low = word.lower()
            out = b"".join([self.pieces[p] if p in self.pieces else self._piece(p) for p in self.PIECE.findall(low)])
        else:  # marks, other scripts: the whole tokenizer
            out = _pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) < 100:
            self.words[word] = out
        return out

    def _piece(self, piece: str) -> bytes:
        plain = piece if piece.isascii() and piece.isprintable() else "".join([self.bytes[b] for b in piece.encode()])
        out = _pack([t.id for t in self.tokenizer.model.tokenize(plain)])
        if len(self.pieces) > MOST:
            self.pieces.clear()
        self.pieces[piece] = out
        return out


def _pack(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])
