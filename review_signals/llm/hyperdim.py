"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is the product of its letters' vectors, each permuted
(rotated) once more than the next; a document is the sum of its n-grams' vectors, a language the sum of the unit vectors
of its documents. A document gets the language whose prototype has the largest cosine with it. Runs of anything but
letters count as one border sign, also around the text, and letters are lower-cased.

Learning is one pass over all learnable documents: each task sends one vector of integers per language, and these are
summed in two steps over ``fan_in`` groups. Only the prototypes, at most ``max_languages``, reach the driver.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be
learned. Ties go to the first language by name. A negative cosine scores 0. Rows without a doc_id are held out.
Repeated rows count and are scored once each. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.shared import is_training, staged
from review_signals.llm.text_arrays import Texts, chunks

UNKNOWN = "und"
_SCALE = 1 << 20
_DOCS_AT_ONCE = 256
#: N-grams whose vectors are in memory at a time, beside the remembered ones.
_GRAMS_AT_ONCE = 4096
_CODE_POINTS = 0x110000


@dataclass(frozen=True)
class Profile:
    dimensions: int = 1024
    letters: int = 3
    seed: int = 20240229
    fan_in: int = 256
    max_languages: int = 10_000
    remembered: int = 40_000


@dataclass
class Encoder:
    """Document vectors; remembers letters and the vectors of n-grams it has met."""

    profile: Profile
    _signs: np.ndarray = field(default_factory=lambda: np.full(_CODE_POINTS, -1, np.int32))
    _known: dict[int, int] = field(default_factory=dict)
    _vectors: np.ndarray | None = None
    _letter_vectors: dict[int, np.ndarray] = field(default_factory=dict)

    def _letters(self, text: str) -> np.ndarray:
        """Code points of lower-case letters; 0 for all else."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        signs = self._signs[points]
        if len(signs) and signs.min() < 0:
            for point in np.unique(points[signs < 0]).tolist():
                low = chr(point).lower()[0]
                self._signs[point] = ord(low) if chr(point).isalpha() else 0
            signs = self._signs[points]
        return signs

    def _letter_vector(self, point: int) -> np.ndarray:
        if point not in self._letter_vectors:
            bits = np.random.Generator(np.random.Philox(key=[self.profile.seed, point])).integers(0, 2, self.profile.dimensions)
            self._letter_vectors[point] = (2 * bits - 1).astype(np.int8)
        return self._letter_vectors[point]

    def _gram_vectors(self, grams: list[tuple[int, ...]]) -> np.ndarray:
        """Vectors of n-grams, from memory or bound anew."""
        width = self.profile.dimensions
        if self._vectors is None or len(self._known) + len(grams) > self.profile.remembered:
            self._known, self._vectors = {}, np.zeros((0, width), np.int8)
        new = [gram for gram in grams if gram not in self._known]
        if new:
            bound = np.ones((len(new), width), np.int8)
            for place in range(self.profile.letters):
                steps = self.profile.letters - 1 - place
                points = [gram[place] for gram in new]
                rolled = {point: np.roll(self._letter_vector(point), steps) for point in set(points)}
                bound *= np.stack([rolled[point] for point in points])
            self._known.update(zip(new, range(len(self._known), len(self._known) + len(new)), strict=True))
            self._vectors = np.concatenate([self._vectors, bound])
        return self._vectors[[self._known[gram] for gram in grams]]

    def documents(self, texts: Texts) -> Iterator[tuple[int, np.ndarray]]:
        """Vectors of some texts at a time, with the number of the first one; zeros where a text has no letter."""
        starts_code_point = (texts.data & 0xC0) != 0x80
        seen = np.concatenate([[0], np.cumsum(starts_code_point)])
        signs = self._letters(texts.data.tobytes().decode("utf-8", "replace")) if len(texts.data) else np.zeros(0, np.int32)
        borders = seen[texts.offsets]
        if borders[-1] != len(signs):  # not valid UTF-8: decode one by one
            parts = [self._letters(raw.decode("utf-8", "replace")) for raw in texts.slices()]
            signs = np.concatenate(parts)
            borders = np.concatenate([[0], np.cumsum([len(part) for part in parts])])
        for low in range(0, len(texts), _DOCS_AT_ONCE):
            high = min(low + _DOCS_AT_ONCE, len(texts))
            yield low, self._vectors_of(signs[borders[low]:borders[high]], borders[low:high + 1] - borders[low])

    def _vectors_of(self, signs: np.ndarray, borders: np.ndarray) -> np.ndarray:
        count, letters = len(borders) - 1, self.profile.letters
        # one border sign before each text and one at the end; other runs of border signs shrink to one
        signs = np.insert(signs, borders, 0).astype(np.int64)
        borders = borders + np.arange(count + 1)
        blank = signs == 0
        begins = blank & ~np.concatenate([[False], blank[:-1]])
        run = np.cumsum(begins) - 1
        is_border, holds_border = np.zeros(len(signs), bool), np.zeros(run[-1] + 1, bool)
        is_border[borders] = True
        holds_border[run[borders]] = True
        shrunk = ~blank | is_border | (begins & ~holds_border[run])
        kept = np.concatenate([[0], np.cumsum(shrunk)])[borders]
        signs = signs[shrunk]
        points, small = _distinct(signs, int(signs.max()) + 1)
        owner = np.repeat(np.arange(count), np.diff(kept))
        base, length = len(points), max(0, len(signs) - letters + 1)
        if not length or base**letters >= 1 << 62:
            codes = np.zeros(0, np.int64)
        else:
            codes = np.zeros(length, np.int64)
            for place in range(letters):
                codes = codes * base + small[place:place + length]
        # an n-gram may end with the sign that opens the next text, as that is its own closing border
        codes_owner = owner[:length] if len(owner) >= length else np.append(owner, np.full(length - len(owner), count - 1))
        last = np.minimum(np.arange(length) + letters - 1, len(signs) - 1)
        inside = last <= kept[codes_owner + 1] if length else np.zeros(0, bool)
        codes, codes_owner = codes[inside], codes_owner[inside]
        grams, which = _distinct(codes, base**letters)
        shown, rest = [], grams
        for _ in range(letters):
            shown.append(points[rest % base])
            rest = rest // base
        as_points = list(zip(*(part.tolist() for part in reversed(shown)), strict=True))
        real = np.array([any(gram) for gram in as_points], bool)
        counts = np.bincount(codes_owner * max(1, len(grams)) + which, minlength=count * max(1, len(grams)))
        counts = counts.reshape(count, max(1, len(grams))).astype(np.float32)[:, : len(grams)] * real
        # some n-grams at a time; the sums are whole numbers, so the order changes nothing
        total = np.zeros((count, self.profile.dimensions), np.float32)
        for low in range(0, len(grams), _GRAMS_AT_ONCE):
            block = slice(low, low + _GRAMS_AT_ONCE)
            total += counts[:, block] @ self._gram_vectors(as_points[block]).astype(np.float32)
        return total


def _distinct(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values below ``bound`` and the place of each value among them; no sort where they are small."""
    if bound > _CODE_POINTS:
        return np.unique(values, return_inverse=True)
    found = np.flatnonzero(np.bincount(values, minlength=1))
    place = np.zeros(bound, np.int64)
    place[found] = np.arange(len(found))
    return found, place[values]


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def learn(docs: DataFrame, profile: Profile = Profile()) -> dict[str, np.ndarray]:  # noqa: B008 - frozen
    """Unit prototypes by language, from all rows with text and language whose id isn't held out."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & is_training(F.col("doc_id")))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sums = Encoder(profile), {}
        for part, texts in chunks(batches, "text"):
            langs = np.array(part.column("lang").to_pylist(), object)
            for low, vectors in encode.documents(texts):
                whole = np.rint(_unit(vectors) * _SCALE).astype(np.int64)
                for lang in set(langs[low:low + len(whole)]):
                    sums[lang] = sums.get(lang, 0) + whole[langs[low:low + len(whole)] == lang].sum(axis=0)
        task = TaskContext.get().partitionId() % profile.fan_in
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([task] * len(sums), pa.int64()),
             pa.array([vector.tolist() for vector in sums.values()], pa.list_(pa.int64()))], names=["lang", "part", "vector"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(frame["vector"].to_numpy()), axis=0, dtype=np.int64)
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "part": [0], "vector": [total]})

    schema = "lang string, part long, vector array<long>"
    partial = rows.select("lang", "text").mapInArrow(bundle, schema).groupBy("lang", "part").applyInPandas(add, schema)
    bundled = staged(partial.groupBy("lang").applyInPandas(add, schema), "prototypes")
    if bundled.count() > profile.max_languages:
        raise ValueError(f"more than {profile.max_languages} languages")
    found = {row["lang"]: np.array(row["vector"], np.float64)[None, :] for row in bundled.collect()}
    return {lang: _unit(found[lang])[0].astype(np.float32) for lang in sorted(found)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], profile: Profile = Profile()) -> DataFrame:  # noqa: B008 - frozen
    """Language and cosine of every whole text."""
    langs = pa.array([*prototypes, UNKNOWN], pa.string())
    matrix = np.stack(list(prototypes.values())) if prototypes else np.zeros((0, profile.dimensions), np.float32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(profile)
        for part, texts in chunks(batches, "text"):
            best, score = np.full(len(texts), len(prototypes)), np.zeros(len(texts))
            for low, vectors in encode.documents(texts):
                if len(matrix):
                    cosines = _unit(vectors) @ matrix.T
                    there = vectors.any(axis=1)
                    best[low:low + len(vectors)] = np.where(there, cosines.argmax(axis=1), len(prototypes))
                    score[low:low + len(vectors)] = np.where(there, np.clip(cosines.max(axis=1), 0, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), langs.take(pa.array(best)), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    held_out = F.coalesce(~is_training(F.col("doc_id")), F.lit(True)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, "text").mapInArrow(
        task, "doc_id long, held_out boolean, lang_pred string, score double")
