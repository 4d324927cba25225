"""Byte-level BPE ids, equal to those of the `tokenizers` file, at a speed that suits whole corpora.

Text is cut before every single space: the pre-tokenizer always starts a piece there, so the ids of
a text are those of its chunks put together. Chunks repeat, so each worker keeps the packed ids of
those it has met; the unknown chunks of a batch are encoded together by the same vocabulary's ranks
and told apart by their byte lengths. Whatever this doesn't cover exactly (white space next to a
space, characters beyond Latin, the special token) goes through `tokenizers` itself.
"""
from __future__ import annotations

import base64
import json
import re
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Chunks a worker remembers (about 250 bytes each) before it starts anew.
REMEMBERED = 200_000
_LAST_PLAIN = "ɏ"
_SPACED = re.compile(r" (?:\s|$)")


class Encoder:
    def __init__(self, tokenizer: str, ranks: str):
        self.file = public_tokenizers.path(tokenizer)
        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.widths = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.widths[rank] = len(token)
        with open(self.file, encoding="utf-8") as text:
            self.special = [token["content"] for token in json.load(text)["added_tokens"]]
        self.known: dict[str, bytes] = {}

    @cached_property
    def exact(self) -> Tokenizer:
        """Loaded by the first text that needs it; most workers never do."""
        return Tokenizer.from_file(self.file)

    def whole(self, text: str) -> bytes:
        """Packed ids by `tokenizers`."""
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, text: str) -> bool:
        return max(text) <= _LAST_PLAIN and not any(s in text for s in self.special)

    def _learn(self, chunks: list[str]) -> None:
        joined = " " + " ".join(chunks)
        if not self._plain(joined) or _SPACED.search(joined):
            plain = []
            for chunk in chunks:
                if not chunk or chunk[0].isspace():
                    continue  # its text is encoded as a whole
                if self._plain(chunk):
                    plain.append(chunk)
                else:
                    self.known[chunk] = self.whole(" " + chunk)
            if not plain:
                return
            chunks, joined = plain, " " + " ".join(plain)
        ids = np.array(self.fast.encode_ordinary(joined), "<u4")
        ends = np.cumsum(self.widths[ids])
        raw = np.frombuffer(joined.encode(), np.uint8)
        wanted = np.append(np.flatnonzero(raw == 32)[1:], len(raw))
        cuts = np.searchsorted(ends, wanted) + 1
        if not np.array_equal(ends[cuts - 1], wanted):
            raise ValueError("a piece reaches over a space")
        packed, cuts = ids.tobytes(), (4 * cuts).tolist()
        self.known.update(zip(chunks, (packed[a:b] for a, b in zip([0, *cuts], cuts, strict=False)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, split, new = self.known, [], {}
        for text in texts:
            first, *rest = text.split(" ")
            split.append((first, rest))
            for chunk in rest:
                if chunk not in known:
                    new[chunk] = None
        self._learn(list(new))
        out = []
        for text, (first, rest) in zip(texts, split, strict=True):
            if not text:
                out.append(b"")
            elif first and self._plain(first):
                try:
                    head = np.array(self.fast.encode_ordinary(first), "<u4").tobytes()
                    out.append(head + b"".join(map(known.__getitem__, rest)))
                except KeyError:
                    out.append(self.whole(text))
            else:
                out.append(self.whole(text))
        return out


@lru_cache(maxsize=2)
def encoder(tokenizer: str = TOKENIZER, ranks: str = RANKS) -> Encoder:
    """One encoder per worker process."""
    return Encoder(tokenizer, ranks)
