"""Token ids of whole texts inside tasks, every frequent word encoded once.

A byte-level BPE never merges across the pieces of its splitting pattern, and
that pattern always cuts before a single space between two visible characters.
Such space-separated words repeat far more often than texts do: the tokenizer
sees each once per worker, later uses come from a table of bounded size. When
it is full, words beyond it are encoded anew each time, which changes no id.

Vocabulary and merges come from the file of the public tokenizer; the merging
itself is done by tiktoken, which takes the same merges in the same order five
times as fast. The tests hold its ids against the library ``tokenizers``.
"""

from __future__ import annotations

import json
import os
from itertools import count

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
WORD_LIMIT = 1_000_000


def _byte_letters() -> dict[int, str]:
    """The letter for each byte in a byte-level vocabulary: itself if it prints, else the next one from 256."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    later = count(256)
    return {b: chr(b) if b in prints else chr(next(later)) for b in range(256)}


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; strings of special tokens are ordinary text."""

    def __init__(self, name_or_path: str = TOKENIZER, word_limit: int = WORD_LIMIT):
        import public_tokenizers
        import tiktoken

        path = name_or_path if os.sep in name_or_path else public_tokenizers.path(name_or_path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_letters()
        byte = {letter: bytes([b]) for b, letter in letters.items()}
        # A token's rank is its place among the merges, behind the single bytes.
        ranks, ids = {bytes([b]): b for b in range(256)}, [model["vocab"][letters[b]] for b in range(256)]
        for merge in model["merges"]:
            token = "".join(merge.split(" ") if isinstance(merge, str) else merge)
            raw = b"".join(byte[c] for c in token)
            if raw not in ranks:
                ranks[raw] = len(ids)
                ids.append(model["vocab"][token])
        self.ranks_of = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.id_of = np.array(ids, dtype="<u4")
        self.with_space = np.zeros(len(ids), dtype=bool)  # ranks whose token begins with a space
        self.with_space[[rank for raw, rank in ranks.items() if raw[:1] == b" "]] = True
        self.word_limit = word_limit
        self.known: dict[str, bytes] = {" ": b""}  # stands for a text's first word, which has no space before it

    def _ids(self, text: str) -> bytes:
        return self.id_of[np.array(self.ranks_of(text), dtype=np.int64)].tobytes()

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that begin and end with a visible character and hold no space, each with the space before it.

        They are encoded as one text: it is cut before each of its spaces, and
        every token that begins with a space begins a word.
        """
        ranks = np.array(self.ranks_of(" " + " ".join(words)), dtype=np.int64)
        begins = np.flatnonzero(self.with_space[ranks])
        if len(begins) != len(words) or begins[0]:
            return {w: self._ids(" " + w) for w in words}
        raw, edges = self.id_of[ranks].tobytes(), [*(4 * begins).tolist(), 4 * len(ranks)]
        return {w: raw[a:b] for w, a, b in zip(words, edges, edges[1:])}

    def encode(self, text: str) -> bytes:
        """Ids of the whole text."""
        words = text.split(" ")
        known = self.known
        first = words[0]
        words[0] = " "
        get = known.get
        found = [get(w) for w in words]
        if None in found:
            missing = {w for w, ids in zip(words, found, strict=True) if ids is None}
            # A word with white space at an end, or an empty one: the cut before its space is not certain.
            if any(not w or w[0].isspace() or w[-1].isspace() for w in missing):
                return self._ids(text)
            new = self._new(list(missing))
            if len(known) + len(new) <= self.word_limit:
                known.update(new)
            found = [new[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
        if not first or first[-1].isspace():
            return self._ids(text)
        found[0] = self._ids(first)
        return b"".join(found)


_encoders: dict[str, WordEncoder] = {}


def encoder(name: str = TOKENIZER) -> WordEncoder:
    """One encoder per worker process."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(name)
    return _encoders[name]
