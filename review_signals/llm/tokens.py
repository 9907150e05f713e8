"""Token ids by the public word BPE, one distinct word at a time.

This tokenizer lower-cases, drops white space and never joins what white space parts, so the ids of a text are the ids
of its words in order. Tasks remember the ids of words they have met (at most ``REMEMBERED``, then they start anew) and
look only distinct words up.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

from review_signals.llm.text_arrays import Texts

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

REMEMBERED = 300_000
#: Text of a task at a time: the more, the fewer look-ups of repeated words.
TOKENISED_BYTES = 1 << 19
#: The end-of-document id that the vocabulary itself provides.
END_OF_TEXT = 49407

_ONE_PRETOKEN = re.compile("[a-zß-öø-ÿ]+")


def _byte_signs() -> dict[int, int]:
    """Byte-level vocabularies show each byte as one sign: itself where it is printable, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {byte: 256 + i for i, byte in enumerate(byte for byte in range(256) if byte not in printable)}


_BYTE_SIGNS = _byte_signs()


class WordEncoder:
    """Ids of texts. ``path`` is the vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        self._place: dict[bytes, int] = {}
        self._starts, self._sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Lower-case words of letters go straight to the merges, others through the whole tokenizer."""
        texts = [word.decode("utf-8", "replace").lower() for word in words]
        merge, letters, found, rest = self._tokenizer.model.tokenize, _ONE_PRETOKEN.fullmatch, [], []
        for i, text in enumerate(texts):
            if letters(text):
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(_BYTE_SIGNS)
                found.append([token.id for token in merge(text)])
            else:
                found.append([])
                rest.append(i)
        originals = [words[i].decode("utf-8", "replace") for i in rest]
        for i, encoded in zip(rest, self._tokenizer.encode_batch_fast(originals, add_special_tokens=False), strict=True):
            found[i] = encoded.ids
        return found

    def _learn(self, words: list[bytes]) -> None:
        if not words:
            return
        found = self._encode_words(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self._place)
        self._place.update(zip(words, range(first, first + len(words)), strict=True))
        self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(sizes) - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._ids = np.concatenate([self._ids, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))])

    def encode(self, texts: Texts) -> Iterator[np.ndarray]:
        """The ids of each text, in order. Each distinct word of the chunk is looked up once."""
        starts, ends = _pretokens(texts)
        lowered = Texts(_LOWER[texts.data], texts.offsets)
        _, first, inverse = np.unique(lowered.hashes(starts, ends), return_index=True, return_inverse=True)
        raw = lowered.data.tobytes()
        words = [raw[low:high] for low, high in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        if len(self._place) > REMEMBERED:
            self._forget()
        self._learn([word for word in words if word not in self._place])
        index = np.fromiter(map(self._place.__getitem__, words), np.int64, len(words))[inverse]
        sizes = self._sizes[index]
        after = np.cumsum(sizes)
        total = int(after[-1]) if len(after) else 0
        ids = self._ids[np.repeat(self._starts[index] - after + sizes, sizes) + np.arange(total)]
        bounds = np.concatenate([[0], after])[np.searchsorted(starts, texts.offsets)].tolist()
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            yield ids[low:high]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SMALL = (np.arange(256) >= 97) & (np.arange(256) <= 122)
#: A pre-token always ends between a letter and one of these signs.
_IS_SIGN = np.isin(np.arange(256), np.frombuffer(b".,!?;:#$%&*|", np.uint8))
#: White space beyond ASCII, as UTF-8.
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WIDE_SPACE_BYTES = re.compile(b"|".join(re.escape(chr(c).encode()) for c in range(0x80, 0x3001) if _WIDE_SPACE.match(chr(c))))


def _pretokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces that are tokenised on their own: words, parted once more before a sign."""
    data, inside = texts.data, texts.inside
    if len(data) and data.max() > 0x7F:
        for found in _WIDE_SPACE_BYTES.finditer(data.tobytes()):
            inside[found.start():found.end()] = False
    small = _IS_SMALL[_LOWER[data]]
    opens = np.zeros(len(data) + 1, bool)
    opens[texts.first] = True
    opens[1:-1] |= ~inside[:-1] | (small[:-1] & _IS_SIGN[data[1:]])
    starts = np.flatnonzero(opens[:-1] & inside)
    # a piece ends at the next start or at the white space or border before it
    stops = np.flatnonzero(np.append(opens[:-1] | ~inside, True))
    return starts, stops[np.searchsorted(stops, starts, side="right")]


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary; its memory of words outlives a task."""
    return WordEncoder(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
