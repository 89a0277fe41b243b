"""Tokens of words by a public vocabulary, each different word encoded once.

Vocabularies that never merge across word borders give a word the same tokens
wherever it stands.  So a slice of text is encoded by its different words, found
by hash, and a bounded store keeps the words of the last slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

from pathloom.llm.textcols import U64

#: Words kept between slices; beyond it the store starts anew, with equal results.
STORE_WORDS = 1 << 20


def sentencepiece_encoder(path: str) -> tuple[Callable, np.ndarray]:
    """Encoder of a list of strings, and for each id whether it is a raw byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    return lambda texts: model.encode(texts, num_threads=1), is_byte


def tiktoken_encoder(path: str) -> Callable:
    """Encoder of a list of strings by a byte-level vocabulary given as ranks."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    model = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    one = model.encode_ordinary
    return lambda texts: [one(t) for t in texts]


class PieceStore:
    """Token lists by word hash, as one flat list with borders."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self.encode = encode
        self.key, self.first, self.count, self.ids = np.empty(0, U64), *(np.empty(0, np.int64),) * 2, np.empty(0, np.int32)

    def lookup(self, keys: np.ndarray, text_of: Callable[[np.ndarray], Iterable[str]]) -> tuple[np.ndarray, np.ndarray]:
        """First place and count, in ``ids``, of the tokens of each key (different
        keys in rising order); ``text_of`` gives the strings of the keys asked for."""
        at = np.searchsorted(self.key, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.key)
        known[inside] = self.key[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.key) + len(new) > STORE_WORDS:
                self.key, self.first, self.count, self.ids = self.key[:0], self.first[:0], self.count[:0], self.ids[:0]
                new = np.arange(len(keys))
            lists = self.encode(list(text_of(new)))
            count = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter((i for x in lists for i in x), np.int32, int(count.sum()))
            first = np.cumsum(count) - count + len(self.ids)
            where = np.searchsorted(self.key, keys[new])
            self.key = np.insert(self.key, where, keys[new])
            self.first = np.insert(self.first, where, first)
            self.count = np.insert(self.count, where, count)
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.key, keys)
        return self.first[at], self.count[at]
