"""Token ids of whole texts, through a table of the words already met.

The vocabulary in use drops white space and never joins what stands on its two sides, so
a text's ids are the ids of its words in a row.  Words repeat far more than texts do: a
batch is cut into words and these into distinct ones by Arrow, each worker keeps a bounded
table of words, and only new words reach the tokenizer.

Plain words (ASCII and Latin letters, which the vocabulary's normaliser only lower-cases)
are cut into pre-tokens here and go straight to the vocabulary's merge table; any other
word takes the tokenizer's whole way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 400_000
SLICE_CHARS = 3 << 20     # characters that are cut into words at a time

_PLAIN = re.compile("[\x00-\x08\x0e-\x1f\x21-\x7eÀ-ÖØ-öø-ɏ]+")
_PRE_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^a-zß-öø-ɏ0-9]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokens(dict):
    """word -> its ids as little-endian 32-bit bytes, computed on the first look-up."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = re.compile("|".join(
            re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"\Z.")
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.parts.clear()
        if _PLAIN.fullmatch(word) and not ("<" in word and self.special.search(word)):
            ids = b"".join([self.parts.get(p) or self._merge(p) for p in _PRE_TOKEN.findall(word.lower())])
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def _merge(self, part: str) -> bytes:
        shown = part.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        self.parts[part] = ids
        return ids

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in a row, and where each text's ids begin and end."""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        known = [self[w] for w in coded.dictionary.to_pylist()]
        sizes = np.array([len(b) >> 2 for b in known], dtype=np.int64)
        ids = np.frombuffer(b"".join(known), "<u4")
        codes = coded.indices.to_numpy(zero_copy_only=False)
        taken = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(taken)])
        begins = (np.cumsum(sizes) - sizes)[codes]
        where = np.repeat(begins - ends[:-1], taken) + np.arange(ends[-1])
        return ids[where], ends[words.offsets.to_numpy().astype(np.int64)]

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of ids of each text."""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        sizes = np.array([len(self[w]) >> 2 for w in coded.dictionary.to_pylist()], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy(zero_copy_only=False)])])
        return np.diff(ends[words.offsets.to_numpy().astype(np.int64)])

    def texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each whole text, in order; a null text has none."""
        held, size = [], 0
        for text in texts:
            if size + len(text or "") > SLICE_CHARS and held:
                yield from self._cut(held)
                held, size = [], 0
            if len(text or "") > SLICE_CHARS:
                yield self._long(text)
                continue
            held.append(text or "")
            size += len(held[-1])
        yield from self._cut(held)

    def _cut(self, held: list[str]) -> Iterator[np.ndarray]:
        if held:
            ids, ends = self.flat(held)
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                yield ids[a:b]

    def _long(self, text: str) -> np.ndarray:
        """A text beyond one slice, taken in slices that end at a space or line end."""
        done, out = 0, []
        while done < len(text):
            stop = done + SLICE_CHARS
            if stop < len(text):
                blank = re.compile(r"[ \n]").search(text, stop)
                stop = blank.start() if blank else len(text)
            out.append(self.flat([text[done:stop]])[0])
            done = stop
        return np.concatenate(out)


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)
