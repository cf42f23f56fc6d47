"""Operator 9: language identification with hyperdimensional profiles."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

#: Length of a vector, letters that are told apart, and the seed of their random vectors.
DIMENSIONS = 1024
SLOTS = 64
SEED = 7
UNKNOWN = "und"
#: Profiles of so many n-grams are kept per worker, and so many languages' sums per task before they are passed on.
_KEPT_GRAMS = 50_000
_KEPT_SUMS = 500
#: Unit vectors are summed as whole numbers of this size, so sums do not depend on their order.
_UNIT = 1 << 16
_STEP = 1 << 20


class Profiles:
    """Turns texts into bundled n-gram vectors.

    Every letter has a random vector of +1 and -1. A trigram is the product of
    its letters' vectors, rotated by their place; a text is the sum over its
    trigrams. Runs of anything but letters count as one boundary letter.
    """

    def __init__(self):
        draw = np.random.default_rng(SEED)
        self._letters = draw.choice(np.array([-1, 1], np.int8), (SLOTS, DIMENSIONS))
        slots = np.zeros(0x110000, np.uint8)
        for code in range(0x110000):
            if chr(code).isalpha():
                plain = code - 96 if 97 <= code <= 122 else 0
                slots[code] = plain or 27 + (code * 2654435761 >> 7) % (SLOTS - 27)
        self._slots = slots
        self._row = np.full(SLOTS**3, -1, np.int32)
        self._grams = np.zeros((1024, DIMENSIONS), np.int8)
        self._used = 0

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        new = grams[self._row[grams] < 0]
        if self._used + len(new) > _KEPT_GRAMS:
            self._row[:], self._used, new = -1, 0, grams
        if len(new):
            end = self._used + len(new)
            while end > len(self._grams):
                self._grams = np.concatenate((self._grams, np.zeros_like(self._grams)))
            first, second, third = new // SLOTS**2, new // SLOTS % SLOTS, new % SLOTS
            self._grams[self._used : end] = (
                np.roll(self._letters[first], 2, axis=1) * np.roll(self._letters[second], 1, axis=1) * self._letters[third]
            )
            self._row[new] = np.arange(self._used, end)
            self._used = end
        return self._row[grams]

    def vector(self, text: str | None) -> np.ndarray | None:
        """The text's vector; None for a null text or one without a letter."""
        if not text:
            return None
        total, carry = None, np.zeros(1, np.uint8)
        # A window takes the last two letters of the one before it along.
        for start in range(0, len(text), _STEP):
            codes = np.frombuffer(text[start : start + _STEP].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            final = start + _STEP >= len(text)
            found = np.concatenate((carry, self._slots[codes], np.zeros(int(final), np.uint8)))
            keep = found != 0
            keep[1:] |= found[:-1] != 0
            keep[0] = True
            found = found[keep].astype(np.int64)
            carry = found[-2:].astype(np.uint8)
            if len(found) < 3:
                continue
            grams, counts = np.unique(found[:-2] * SLOTS**2 + found[1:-1] * SLOTS + found[2:], return_counts=True)
            for at in range(0, len(grams), 8192):
                rows = self._rows(grams[at : at + 8192])
                part = counts[at : at + 8192].astype(np.float32) @ self._grams[rows].astype(np.float32)
                total = part if total is None else total + part
        return total


_PROFILES: list[Profiles] = []


def _profiles() -> Profiles:
    if not _PROFILES:
        _PROFILES.append(Profiles())
    return _PROFILES[0]


@dataclass(frozen=True)
class LanguageModel:
    """One prototype of length 1 per language; its size depends on the number of languages alone."""

    languages: tuple[str, ...]
    prototypes: np.ndarray


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Prototypes from all labelled rows of ``docs``: per language the sum of its texts' unit vectors.

    One pass: every task sums by language, and the sums are added by a Spark
    aggregation over language and dimension. The driver gets one vector per
    language. Rows without language, text or letter teach nothing.
    """
    slim = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )

    def sums(batches):
        profiles, totals = _profiles(), {}

        def passed_on():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.list_(pa.int64()))], ["lang", "total"]
            )
            totals.clear()
            return batch

        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                vector = profiles.vector(value.as_py())
                length = 0.0 if vector is None else float(np.linalg.norm(vector))
                if length:
                    unit = np.rint(vector.astype(np.float64) * (_UNIT / length)).astype(np.int64)
                    totals[language] = totals[language] + unit if language in totals else unit
                    if len(totals) > _KEPT_SUMS:
                        yield passed_on()
        if totals:
            yield passed_on()

    parts = slim.mapInArrow(sums, "lang string, total array<long>")
    added = parts.select("lang", F.posexplode("total").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    vectors: dict[str, np.ndarray] = {}
    for row in added.collect():
        vectors.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["at"]] = row["value"]
    languages = tuple(sorted(vectors))
    stacked = np.array([vectors[name] for name in languages]).reshape(len(languages), DIMENSIONS)
    lengths = np.linalg.norm(stacked, axis=1, keepdims=True)
    return LanguageModel(languages, stacked / np.where(lengths == 0, 1, lengths))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, the cosine with the nearest prototype from 0 to 1.

    Only the text decides. Null text, text without a letter and a model without
    languages give ``und`` and 0; equal cosines go to the first language by
    name. Repeated rows get equal answers. Columns named ``lang_pred`` or
    ``score`` are replaced, others pass through. An empty table gives no rows.
    """
    names, prototypes = model.languages, model.prototypes
    kept = docs.drop("lang_pred", "score")
    columns = kept.columns
    at = columns.index(text)

    def predict(batches):
        profiles = _profiles()
        for batch in batches:
            found, scores = [], []
            for value in batch.column(at):
                vector = profiles.vector(value.as_py())
                length = 0.0 if vector is None else float(np.linalg.norm(vector))
                if not length or not names:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = prototypes @ (vector.astype(np.float64) / length)
                best = int(np.argmax(cosines))
                found.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "score"],
            )

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return kept.mapInArrow(predict, StructType([*kept.schema.fields, *added]))


def identify_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; prototypes come from the rows that are not held out.

    Rows are held out by the crc32 of their id. A null id is neither held out
    nor learned from.
    """
    model = learn(docs.filter(remainder(F.col(doc_id)) != 0), text, lang)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return identify(slim, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
