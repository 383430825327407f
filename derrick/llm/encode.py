"""Token ids of whole texts by a public tokenizer file, with a bounded word cache.

A text is cut where white space begins after something else; no token crosses
such a place, so the pieces' ids joined are the text's ids. Texts with white
space other than space and newline go to the tokenizer whole. Pieces seen before
come from a cache that stops growing at ``CACHE`` entries; new ones are normalised and
cut into words as the tokenizer does, and the library's model encodes each word.
Where a text has single spaces and newlines only, its pieces are those of a plain
split at spaces (kept without the space in front, in a cache of their own).
"""

from __future__ import annotations

import json
import os
import re

import regex

CACHE = 500_000

_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_ODD = re.compile(r"[^\S \n]")
#: no combining marks and no letters whose lower case depends on their place
_PLAIN = re.compile(r"[\x00-\u012f]*")
_STOPS = frozenset(".,;:!?")
_BYTE_WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> list[str]:
    """The character that byte-level models use for each byte: printable ones stand
    for themselves, the others follow from U+0100 in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


def tokenizer_file(name: str) -> str:
    """A path as it is; else the file of that name among the public tokenizers."""
    if os.path.exists(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """``ids(texts)``: little-endian unsigned 32-bit ids per text (null: empty)."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        path = tokenizer_file(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        with open(path) as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        self.normal = self.tokenizer.normalizer
        split = [p for p in (spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]])
                 if p["type"] == "Split"]
        self.spaced = not split                   # words keep the space before them
        self.words = _BYTE_WORDS if self.spaced else regex.compile(split[0]["pattern"]["Regex"])
        self.lowers = self.normal is not None
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(_byte_letters()))
        self.raw = [i.to_bytes(4, "little") for i in range(max(self.size, 1))]
        self.pieces: dict[str, bytes] = {}
        self.after: dict[str, bytes] = {}         # pieces less the space before them
        self.known: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.raw[i] for i in ids])

    def _cut(self, p: str) -> list[str]:
        """Words of a piece."""
        if self.lowers:
            p = p.lower() if _PLAIN.fullmatch(p) else self.normal.normalize_str(p)
        if self.spaced:
            w = p[1:] if p[:1] == " " else p
            if w.isalpha():
                return [p]
            if w[-1:] in _STOPS and w[:-1].isalpha():
                return [p[:-1], w[-1]]
            if p[:1] == "\n" and p[1:].isalpha():
                return ["\n", p[1:]]
        else:
            w = p.strip(" \n")
            if w.isalpha():
                return [w]
            if w[-1:] in _STOPS and w[:-1].isalpha():
                return [w[:-1], w[-1]]
        return self.words.findall(p)

    def _word(self, w: str) -> bytes:
        if w.isascii() and w.isalpha():
            form = w
        elif w[:1] == " " and w[1:].isascii() and w[1:].isalpha():
            form = self.letters[32] + w[1:]
        else:
            form = w.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.raw[t.id] for t in self.model.tokenize(form)])

    def _piece(self, p: str) -> bytes:
        for s in self.special:
            if s in p:
                return self._bytes(self.tokenizer.encode(p, add_special_tokens=False).ids)
        known, out = self.known, []
        for w in self._cut(p):
            ids = known.get(w)
            if ids is None:
                ids = self._word(w)
                if len(known) < CACHE:
                    known[w] = ids
            out.append(ids)
        return b"".join(out)

    def _cached(self, have: dict[str, bytes], cut: list[str], space: str = "") -> list[bytes]:
        """Ids of pieces through the cache ``have``; ``space`` was left off pieces
        that don't begin with a newline."""
        got = list(map(have.get, cut))
        i = -1
        for _ in range(got.count(None)):
            i = got.index(None, i + 1)
            p = cut[i]
            ids = have.get(p)                     # met twice in this text
            if ids is None:
                ids = self._piece(p if p[:1] == "\n" else space + p)
                if len(have) < CACHE:
                    have[p] = ids
            got[i] = ids
        return got

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for t in texts:
            if t and _ODD.search(t):
                out.append(self._bytes(self.tokenizer.encode(t, add_special_tokens=False).ids))
                continue
            cut = (t or "").replace("\n", " \n").split(" ")
            if "" in cut or "\n" in cut:          # runs of white space, or some at an end
                got = self._cached(self.pieces, _PIECE.findall(t or ""))
            else:
                got = self._cached(self.pieces, cut[:1])
                got += self._cached(self.after, cut[1:], " ")
            out.append(b"".join(got))
        return out


def encoder(name: str, _made: dict = {}) -> Encoder:  # noqa: B006  (one per worker)
    if name not in _made:
        _made[name] = Encoder(name)
    return _made[name]


def blocks(texts: list[str | None], limit: int = 1 << 21):
    """Slices of about ``limit`` characters (never less than one text)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
