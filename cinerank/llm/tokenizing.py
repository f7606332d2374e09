"""Public tokenizers inside tasks: loaded once per Python worker."""

from __future__ import annotations

import base64
import functools
import os

import numpy as np


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder(dict):
    """Ids of texts by a ``tokenizers`` file that drops white space and lower-cases,
    so that a text's ids are its words' ids one after another, and A-Z may be
    lower-cased beforehand.

    Words recur, so their ids (little-endian unsigned 32-bit) are kept here, for
    at most ``max_words`` words of at most ``max_bytes`` bytes; when full, the
    store starts anew.  This only saves time: every text is encoded whole.
    """

    def __init__(self, path: str, max_words: int = 1_000_000, max_bytes: int = 48):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = self._letters()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.max_words, self.max_bytes = max_words, max_bytes

    def __missing__(self, word: bytes) -> bytes:
        # A mark after an ASCII letter or digit starts a token of its own.
        if len(word) > 1 and word[-1:] in (b".", b",") and word[-2:-1].isalnum():
            ids = self[word[:-1]] + self[word[-1:]]
        else:
            ids = np.array(self.word_ids(word), "<u4").tobytes()
            if len(word) <= self.max_bytes:
                self[word] = ids
        return ids

    def _letters(self) -> dict[str, str]:
        """What the steps before the model make of each Latin letter within a word
        (below U+0300 no letters compose with each other): words of these alone
        go to the model directly, several times faster than by ``encode``."""
        normal, split = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        edge = len(split("a")[0][0])
        found = {}
        for c in map(chr, range(0x21, 0x300)):
            low = normal(c)
            pieces = split(f"a{low}a")
            if c.isalpha() and len(low) == 1 and normal(f"a{low}a") == f"a{low}a" and len(pieces) == 1:
                found[c] = pieces[0][0][edge:-edge]
        return found

    def word_ids(self, word: bytes) -> list[int]:
        text = word.decode("utf-8", "replace")
        try:
            piece = "".join(map(self.letters.__getitem__, text))
        except KeyError:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [token.id for token in self.model.tokenize(piece)]

    def encode(self, text: str | None) -> bytes:
        data = text.encode("utf-8", "surrogatepass") if text else b""
        low = data.lower()                                   # bytes: A-Z only
        if not any(s in low for s in self.special):          # special strings are matched as they are written
            data = low
        ids = b"".join(map(self.__getitem__, data.split()))
        if len(self) > self.max_words:
            self.clear()
        return ids


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class ByteEncoder:
    """Ids of whole texts by byte-level ``tiktoken`` ranks, with each token's
    byte length: tokens spell the text's UTF-8, so sums of lengths are offsets."""

    def __init__(self, path: str, pattern: str | None = None):
        import tiktoken

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset after each token of the text."""
        return np.cumsum(self.lengths[np.array(self.encoding.encode_ordinary(text), np.int64)])


@functools.lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str | None = None) -> ByteEncoder:
    return ByteEncoder(path, pattern)
