"""Token ids of a merge-type (BPE) SentencePiece model, exact and without running the merges over the text.

A sequence of pieces is what the merges give exactly if each two neighbours are: if their text alone, merged again, comes
back as these two pieces. So a word is encoded by backtracking. An Aho-Corasick automaton over the reversed pieces lists,
for every position, the pieces that start there, longest first. The longest one that is compatible with its left
neighbour is taken; where none is left, the position fails for good (the pieces before a position are the only ones
possible), is remembered in a bitfield, and the last piece is taken back for a shorter one.

Texts are cut into words first, between two characters that stand next to each other in no piece: no merge crosses
there. Workers remember words and compared neighbours (at most ``REMEMBERED`` of each, then they start anew).

Read from the model file are pieces, scores, kinds and the normaliser's switches. Models with a character map, with
pieces defined by the user, with white space as suffix or of another type are refused.

Defined cases: null and empty texts have no ids and decode to the empty text. The sign that stands for a space in pieces,
met in a text, counts as a space, as in the library. Characters without a piece become byte pieces. Very long words are
matched in blocks, very long texts are cut into words in blocks. Every row is encoded for itself, so repeated rows give
repeated results; a null doc_id is kept; columns other than id and text are not read. Empty tables stay empty.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.text_arrays import chunks, tidy

SPACE = "▁"
REMEMBERED = 400_000
#: Characters of a word whose pieces are listed at a time, and of a text that is cut into words at a time.
BLOCK = 4096
TEXT_BLOCK = 1 << 17

# Kinds of pieces, the model type and the default unknown sign of the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
UNKNOWN_SURFACE = " ⁇ "


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, message[at:at + size]
        at += size


@dataclass(frozen=True)
class Model:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    prefix: bool
    unknown_surface: str

    @staticmethod
    def read(path: str) -> Model:
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        pieces, scores, kinds = [], [], []
        for piece in (dict(_fields(value)) for key, value in fields if key == 1):
            pieces.append(piece.get(1, b"").decode())
            scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
            kinds.append(piece.get(3, NORMAL))
        trainer = dict(chain.from_iterable(_fields(value) for key, value in fields if key == 2))
        normaliser = dict(chain.from_iterable(_fields(value) for key, value in fields if key == 3))
        if trainer.get(3, 1) != BPE or not trainer.get(35, 0) or trainer.get(24, 0) or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError(f"{path} is no merge-type model with byte fallback and plain pieces")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
            raise ValueError(f"{path} changes texts before they are encoded")
        return Model(pieces, scores, kinds, bool(normaliser.get(3, 1)), trainer.get(44, UNKNOWN_SURFACE.encode()).decode())


class Encoder:
    """Ids of texts, and texts of ids."""

    def __init__(self, path: str) -> None:
        model = self.model = Model.read(path)
        plain = [i for i, kind in enumerate(model.kinds) if kind == NORMAL]
        self.ids = {model.pieces[i]: i for i in plain}
        self.scores = {model.pieces[i]: model.scores[i] for i in plain}
        self.bytes = {int(model.pieces[i][3:5], 16): i for i, kind in enumerate(model.kinds) if kind == BYTE}
        alphabet = {sign for piece in self.ids for sign in piece}
        #: All that a word can consist of; a character without a piece is one, too.
        self.names = sorted({*self.ids, *alphabet})
        place = {name: k for k, name in enumerate(self.names)}
        self.sizes = [len(name) for name in self.names]
        #: The longest other name that each name starts with, or -1.
        self.shorter = [
            next((place[name[:k]] for k in range(len(name) - 1, 0, -1) if name[:k] in place), -1) for name in self.names]
        self.name_ids = [self._piece_ids(name) for name in self.names]
        self.longest = max(self.sizes, default=1)
        self.automaton = ahocorasick.Automaton()
        for k, name in enumerate(self.names):
            self.automaton.add_word(name[::-1], k)
        self.automaton.make_automaton()
        self.between = next(chr(code) for code in range(len(alphabet) + 1) if chr(code) not in alphabet)
        pairs = {piece[k:k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        # spaces stand for their sign in texts
        pairs = {pair.replace(SPACE, " ") for pair in pairs}
        self._joined = np.zeros((256, 256), bool)
        wide = []
        for first, second in (map(ord, pair) for pair in pairs):
            if first < 128 and second < 128:
                self._joined[first, second] = True
            else:
                wide.append(first << 21 | second)
        self._wide = np.array(sorted(wide), np.int64)
        self._forget()
        self._fits: dict[int, bool] = {}
        self._surface = [self._shown(i) for i in range(len(model.pieces))]
        self._is_part = np.array([isinstance(shown, int) for shown in self._surface])

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        #: Where the ids of each word begin and end, and the ids; all with room for more.
        self._bounds, self._known = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32)

    # words

    def cuts(self, text: str) -> np.ndarray:
        """Positions between two characters that no merge joins."""
        signs = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        narrow = np.minimum(signs, 128).astype(np.uint16)
        joined = self._joined.ravel()[narrow[:-1] << 8 | narrow[1:]]
        wide = narrow == 128
        other = np.flatnonzero(wide[:-1] | wide[1:])
        if len(other) and len(self._wide):
            asked = signs[other].astype(np.int64) << 21 | signs[other + 1]
            found = np.minimum(np.searchsorted(self._wide, asked), len(self._wide) - 1)
            joined[other] = self._wide[found] == asked
        return np.flatnonzero(~joined) + 1

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text that was prepared, some at a time."""
        held = ""
        for low in range(0, len(text), TEXT_BLOCK):
            held += text[low:low + TEXT_BLOCK]
            bounds = [0, *self.cuts(held).tolist()]
            yield [held[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            held = held[bounds[-1]:]
        if held:
            yield [held]

    def prepared(self, text: str) -> str:
        """The text with all spaces as spaces, and one in front of it."""
        text = text.replace(SPACE, " ")
        return f" {text}" if text and self.model.prefix else text

    # one word

    def merged(self, text: str) -> list[str]:
        """What the merges leave of a short text: always the best pair of neighbours, the first of equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, 0
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces can be neighbours."""
        key = left * len(self.names) + right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > REMEMBERED:
                self._fits.clear()
            first, second = self.names[left], self.names[right]
            known = self._fits[key] = self.merged(first + second) == [first, second]
        return known

    def matches(self, text: str) -> dict[int, int]:
        """The longest piece from each position on; keys count positions from the end of the text."""
        # of the pieces that end at one place the automaton gives the longest first; the last one given stays
        return dict(list(self.automaton.iter(text[::-1]))[::-1])

    def block(self, word: str, number: int) -> tuple[int, dict[int, int]]:
        """The matches of a block of a word, and the last position that they reach."""
        reach = word[number * BLOCK:(number + 1) * BLOCK + self.longest - 1]
        return number * BLOCK + len(reach) - 1, self.matches(reach)

    def pieces(self, word: str, last: int, found: dict[int, int]) -> list[int]:
        """The pieces of a word whose characters all occur in pieces, as numbers of names; the longest piece at a
        position is ``found`` at ``last`` less the position, in the first block."""
        size, sizes, shorter, known, count = len(word), self.sizes, self.shorter, self._fits, len(self.names)
        if sizes[found[last]] == size and self.merged(word) == [word]:
            return [found[last]]
        blocks = {0: (last, found)}
        failed, taken = bytearray(size // 8 + 1), []
        at, piece = 0, found[last]
        while True:
            left = taken[-1] if taken else -1
            while piece >= 0:
                end = at + sizes[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if left < 0:
                        break
                    fits = known.get(left * count + piece)
                    if fits or (fits is None and self.fits(left, piece)):
                        break
                piece = shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= sizes[left]
                piece = shorter[taken.pop()]
                continue
            taken.append(piece)
            at = end
            if at == size:
                return taken
            if size > BLOCK:
                number = at // BLOCK
                if number not in blocks:
                    if len(blocks) > 2:
                        blocks.clear()
                    blocks[number] = self.block(word, number)
                last, found = blocks[number]
            piece = found[last - at]

    def _piece_ids(self, name: str) -> list[int]:
        number = self.ids.get(name)
        return [number] if number is not None else [self.bytes[byte] for byte in name.encode("utf-8", "replace")]

    def words_ids(self, words: list[str]) -> list[list[int]]:
        """The ids of each word. Short words are matched by one scan for all."""
        words = [word.replace(" ", SPACE) for word in words]
        short = [word for word in words if len(word) <= BLOCK]
        found = self.matches(self.between.join(short))
        last, ids, out = sum(map(len, short)) + len(short) - 2, self.name_ids, []
        for word in words:
            if len(word) == 1:
                out.append(self._piece_ids(word))
            else:
                pieces = self.pieces(word, last, found) if len(word) <= BLOCK else self.pieces(word, *self.block(word, 0))
                out.append(list(chain.from_iterable([ids[piece] for piece in pieces])))
            if len(word) <= BLOCK:
                last -= len(word) + 1
        return out

    # texts

    def _learn(self, words: list[str]) -> None:
        found = self.words_ids(words)
        first, size = len(self._place), sum(map(len, found))
        begin = int(self._bounds[first])
        self._bounds = _with_room(self._bounds, first + len(words) + 1)
        self._known = _with_room(self._known, begin + size)
        self._bounds[first + 1:first + len(words) + 1] = begin + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        self._known[begin:begin + size] = np.fromiter(chain.from_iterable(found), np.int32, size)
        self._place.update(zip(words, range(first, first + len(words)), strict=True))

    def _look_up(self, words: list[str]) -> np.ndarray:
        """The ids of some words, one after the other."""
        if len(self._place) > REMEMBERED:
            self._forget()
        new = set(words).difference(self._place)
        if new:
            self._learn(list(new))
        index = np.fromiter(map(self._place.__getitem__, words), np.int64, len(words))
        sizes = self._bounds[index + 1] - self._bounds[index]
        after = np.cumsum(sizes)
        total = int(after[-1]) if len(after) else 0
        return self._known[np.repeat(self._bounds[index] - after + sizes, sizes) + np.arange(total)]

    def encode(self, text: str) -> np.ndarray:
        parts = [self._look_up(words) for words in self.words(self.prepared(text))]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def _shown(self, number: int) -> bytes | int:
        """What an id shows: text, or a byte that may be part of a character."""
        kind, piece = self.model.kinds[number], self.model.pieces[number]
        if kind == BYTE:
            byte = int(piece[3:5], 16)
            return byte if byte > 127 else bytes([byte])
        if kind in (CONTROL, UNKNOWN):
            return b"" if kind == CONTROL else self.model.unknown_surface.encode()
        return piece.replace(SPACE, " ").encode()

    def decode(self, numbers: np.ndarray) -> str:
        """The text of any ids. The space in front of a text goes; bytes that are no character show as U+FFFD."""
        ids = numbers.tolist()
        shown = list(map(self._surface.__getitem__, ids))
        first = 0  # ids that show nothing don't end the beginning of a text
        while first < len(shown) and shown[first] == b"":
            first += 1
        if self.model.prefix and first < len(shown) and self.model.kinds[ids[first]] == NORMAL:
            shown[first] = shown[first].removeprefix(b" ")  # type: ignore[union-attr]
        if not self._is_part[numbers].any():
            return b"".join(shown).decode()  # type: ignore[arg-type]
        out: list[bytes] = []
        low = 0
        while low < len(shown):
            if isinstance(shown[low], bytes):
                out.append(shown[low])  # type: ignore[arg-type]
                low += 1
                continue
            high = low
            while high < len(shown) and isinstance(shown[high], int):
                high += 1
            out.append(_characters(bytes(shown[low:high])))  # type: ignore[arg-type]
            low = high
        return b"".join(out).decode()


def _with_room(values: np.ndarray, size: int) -> np.ndarray:
    """The array itself, or if it is too small a copy with twice the room."""
    return values if size <= len(values) else np.concatenate([values, np.zeros(2 * size - len(values), values.dtype)])


def _characters(raw: bytes) -> bytes:
    """Bytes as text, each byte that belongs to no character as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = 1 if raw[at] < 0x80 else 2 if raw[at] >> 5 == 6 else 3 if raw[at] >> 4 == 14 else 4 if raw[at] >> 3 == 30 else 0
        try:
            out.append(raw[at:at + size].decode() if size else "�")
            at += size or 1
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out).encode()


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and model; its memory of words outlives a task."""
    return Encoder(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per row its doc_id, ``ids`` and ``decoded``, the text that the ids give back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for part, texts in chunks(batches, "text"):
            found = [coder.encode(raw.decode("utf-8", "replace")) for raw in texts.slices()]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            ids = pa.array(np.concatenate(found) if found else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), ids),
                pa.array([coder.decode(own) for own in found], pa.string()),
            ], names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(task), "doc_id long, ids array<int>, decoded string")


def digest(coded: DataFrame) -> DataFrame:
    """The number of ids, and hashes of them (decimal, joined by commas) and of the decoded text."""
    joined = F.btrim(F.replace(F.col("ids").cast("string"), F.lit(", "), F.lit(",")), F.lit("[]"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
