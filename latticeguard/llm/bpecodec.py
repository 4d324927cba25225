"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece there is exactly one token that its encoding ends with. An Aho-Corasick
automaton of the vocabulary stands at the longest suffix of the prefix that begins a token, and its
output links list the tokens that are suffixes of the prefix. Such a token is the prefix's last one
if it is compatible with the last token of the prefix in front of it: if the two tokens' bytes put
together are encoded as just these two. The stored last tokens are back-pointers, from the piece's
end to its start. Work is linear in a piece's length, however long it is, and no merge is simulated.

Two tokens are compatible if no merge reaches over the seam. The merges of both are undone where
they touch it, the younger first; a pair at the seam that would have been merged before the merge
just undone rules them out (`Codec.compatible`).

Pieces are cut by the vocabulary's own pattern. It always starts a piece at a space with no blank
behind it, so a text without runs of blanks is cut at its spaces first; a worker remembers the ids
of such words and of short pieces.
"""
from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from latticeguard.llm.common import free_name

TOKENIZER = "byte_bpe_50k.json"
#: Words, pieces (about 200 bytes each) and token pairs a worker keeps in one place before it starts anew,
#: and the longest word that it keeps.
WORDS = 450_000
PIECES = 50_000
SEAMS = 1_000_000
LONGEST = 48
_BYTES = 256
_NEVER = 1 << 62
_WORD = re.compile(r"([^\W\d_]+)([^\w\s]+)")
_RUN = re.compile(r" (?:\s|$)")
#: Characters of which all Unicode versions in use agree whether they are letters, digits or blanks.
_OTHERS = re.compile("[^\x00-ԯ‐-‧€]")


def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary file stands for: itself where it is printable
    Latin-1, and the other bytes, in order, from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = sorted(set(range(_BYTES)) - set(printable))
    return {chr(b): b for b in printable} | {chr(_BYTES + i): b for i, b in enumerate(rest)}


class Codec:
    """Ids of texts and texts of ids for one vocabulary file; `known` and `words` map pieces, and what
    follows a space up to the next one, to packed ids."""

    def __init__(self, tokenizer: str = TOKENIZER):
        with open(public_tokenizers.path(tokenizer), encoding="utf-8") as text:
            spec = json.load(text)
        model, byte = spec["model"], byte_of_char()
        names = sorted(model["vocab"], key=model["vocab"].__getitem__)
        self.bytes = [bytes(byte[c] for c in name) for name in names]
        self.size = len(names)
        self.tokens = {raw: token for token, raw in enumerate(self.bytes)}
        self.byte_ids = bytes(self.tokens[bytes([b])] for b in range(_BYTES))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = model["vocab"]
        self.head, self.tail, self.pairs = list(range(_BYTES)), list(range(_BYTES)), {}
        for left, right in merges:
            made = len(self.head)
            if ids[left + right] != made:
                raise ValueError("ids must follow the order of the merges")
            self.head.append(ids[left])
            self.tail.append(ids[right])
            self.pairs[ids[left] * self.size + ids[right]] = made
        if self.size != len(self.head) or {len(b) for b in self.bytes[:_BYTES]} != {1}:
            raise ValueError("the vocabulary must be the bytes and the merges' results")
        self.automaton = ahocorasick.Automaton()
        for token, raw in enumerate(self.bytes):
            if len(raw) > 1:
                self.automaton.add_word(raw.decode("latin-1"), (len(raw), token))
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cutter = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.texts = [self.bytes[i] if i < self.size else b"" for i in range(max([self.size - 1, *self.special.values()]) + 1)]
        for content, token in self.special.items():
            self.texts[token] = content.encode()
        self.seams: list[dict[int, bool]] = [{} for _ in range(self.size + 1)]
        self.n_seams = 0
        self.wire = [struct.pack("<I", token) for token in range(self.size)]
        self.known = _Remembered(lambda piece: self._packed_piece(piece.encode()))
        self.words = _Remembered(self._word)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, put together, are encoded as just these two."""
        before = _NEVER
        while True:
            if self.pairs.get(left * self.size + right, _NEVER) < before:
                return False
            if left < _BYTES and right < _BYTES:
                return True
            if left > right:
                before, left = left, self.tail[left]
            else:  # of equal merges the left one comes first, so one across the seam precedes the right one
                before, right = right + 1, self.head[right]

    def _fits(self, before: int, token: int) -> bool:
        """Whether `token` can follow `before`, the last token so far (`size` at a piece's start)."""
        found = self.seams[before].get(token)
        if found is not None:
            return found
        if before < self.size:
            found = self._fits(self.size, token) and self.compatible(before, token)
        else:  # a token whose bytes are encoded in another way is never made
            raw = self.bytes[token]
            last = self._last_tokens(raw[:-1])
            ways = ((last[at], self.tokens.get(raw[at:])) for at in range(1, len(raw)))
            found = not any(tail is not None and self._fits(head, tail) for head, tail in ways)
        self.seams[before][token] = found
        self.n_seams += 1
        return found

    def _last_tokens(self, piece: bytes) -> list[int]:
        """The last token of every prefix, by its length (`size` for the empty one).

        Every prefix has exactly one, so it is the prefix's last byte if no longer token fits.
        """
        seams, done = self.seams, 0
        last = [self.size, *piece.translate(self.byte_ids)]
        for end, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            if end == done:
                continue
            before = last[end + 1 - length]
            try:
                fits = seams[before][token]
            except KeyError:
                fits = self._fits(before, token)
            if fits:
                last[end + 1] = token
                done = end
        return last

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one non-empty piece."""
        last, ids, at, texts = self._last_tokens(piece), [], len(piece), self.bytes
        while at:
            token = last[at]
            ids.append(token)
            at -= len(texts[token])
        ids.reverse()
        return ids

    def _packed_piece(self, piece: bytes) -> bytes:
        """Packed ids of one non-empty piece."""
        last, out, at, texts, wire = self._last_tokens(piece), [], len(piece), self.bytes, self.wire
        while at:
            token = last[at]
            out.append(wire[token])
            at -= len(texts[token])
        out.reverse()
        return b"".join(out)

    def _word(self, word: str) -> bytes:
        """Ids of a space and the word: of its letters, which are looked up as a word of their own, and of what
        follows them, if there is nothing else."""
        if word.isascii() or not _OTHERS.search(word):
            if word.isalpha():
                return self._packed_piece(b" " + word.encode())
            plain = _WORD.fullmatch(word)
            if plain is not None and plain[1].isalpha():
                return self.words[plain[1]] + self.known[plain[2]]
        return b"".join(map(self.known.__getitem__, self.pieces(" " + word)))

    def pieces(self, text: str) -> list[str]:
        """The pieces that are encoded by themselves."""
        if text.isascii() or not _OTHERS.search(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]

    def encode(self, text: str | None) -> bytes:
        """Packed ids (little-endian, 32 bits each) of a text; none for null."""
        if not text:
            return b""
        self.known.trim(PIECES)
        self.words.trim(WORDS)
        if self.n_seams > SEAMS:
            self.n_seams = 0
            for after in self.seams:
                after.clear()
        if not any(map(text.__contains__, self.special)):
            return self._ordinary(text)
        return b"".join(packed([self.special[part]]) if i % 2 else self._ordinary(part)
                        for i, part in enumerate(self.specials.split(text)))

    def _ordinary(self, text: str) -> bytes:
        if _RUN.search(text):
            return b"".join(map(self.known.__getitem__, self.pieces(text)))
        first, *words = text.split(" ")
        return b"".join([*map(self.known.__getitem__, self.pieces(first)), *map(self.words.__getitem__, words)])

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids; ids the vocabulary lacks are left out, broken UTF-8 becomes U+FFFD."""
        if not ids:
            return ""
        texts = self.texts
        each = np.frombuffer(ids, "<u4").tolist()
        try:
            raw = b"".join(map(texts.__getitem__, each))
        except IndexError:
            raw = b"".join(texts[i] for i in each if i < len(texts))
        return raw.decode("utf-8", "replace")


class _Remembered(dict):
    """Results of a function, made when first asked for. When it is full, a second dictionary keeps what it
    held, so that what is asked for again isn't made again; results of long arguments aren't kept."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            self[key] = value
        return value

    def trim(self, most: int) -> None:
        if len(self) > most:
            self.older = dict(self)
            self.clear()


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def codec(tokenizer: str = TOKENIZER) -> Codec:
    """One codec per worker process."""
    return Codec(tokenizer)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """`docs` with the ids of its texts: a binary of little-endian unsigned 32-bit integers.

    Ids equal those of the `tokenizers` file without special tokens added; a special token that a text
    spells out is that token. Null and empty texts have no ids. Texts of any length are encoded whole,
    repeated rows get equal ids, an empty table gives no rows. The new column gets an underscore in
    front where `docs` has its name already.
    """

    @F.arrow_udf("binary")
    def encoded(column: pa.Array) -> pa.Array:
        at_work = codec(tokenizer)
        return pa.array([at_work.encode(t.as_py()) for t in column], pa.binary())

    return docs.withColumn(free_name(docs, ids), encoded(F.col(f"`{text}`")))


def decode(coded: DataFrame, ids: str = "ids", text: str = "decoded", tokenizer: str = TOKENIZER) -> DataFrame:
    """`coded` with the text that its packed ids spell; null and empty ids spell the empty text.

    Special tokens are kept. The new column gets an underscore in front where its name is taken.
    """

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        at_work = codec(tokenizer)
        return pa.array([at_work.decode(i.as_py()) for i in column], pa.string())

    return coded.withColumn(free_name(coded, text), decoded(F.col(f"`{ids}`")))
