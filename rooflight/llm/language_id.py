"""Language identification with hyperdimensional profiles.

Every letter has a seeded random vector of +1 and -1. A trigram's vector binds its letters' vectors,
permuted by their place (rolled by two, one and no steps, multiplied together); a text's vector
bundles (adds) those of its trigrams, word ends being a letter of their own. A language's prototype
bundles the texts labelled with it. The prediction is the language whose prototype has the largest
cosine with the text's vector, once the part that all prototypes share has been taken off.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is everything if no
label was learned; ties go to the smaller language; a null id is held out as empty text would be;
repeated rows are predicted (and learned) each; whole texts are read, in pieces; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooflight.llm.shared import held_out

DIMENSIONS = 1024
SEED = 7
UNKNOWN = "und"
_PIECE = 1 << 18  # characters bundled at once
_DOCS = 256
_GRAMS = 8192  # vectors of distinct trigrams held at once


@cache
def _letters() -> np.ndarray:
    """Code point to lower-case letter, 0 for what is no letter."""
    out = np.zeros(0x110000, np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


class LetterVectors:
    def __init__(self, dim: int = DIMENSIONS):
        self.dim, self.known = dim, {}

    def __call__(self, letters: np.ndarray) -> np.ndarray:
        for c in letters.tolist():
            if c not in self.known:
                bits = np.random.Generator(np.random.PCG64([SEED, c])).integers(0, 2, self.dim, np.int8)
                self.known[c] = bits * np.int8(2) - np.int8(1)
        return np.stack([self.known[c] for c in letters.tolist()])

    def grams(self, grams: np.ndarray) -> np.ndarray:
        """Vectors (float32) of packed trigrams."""
        letters = np.unique(np.concatenate([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF]))
        one = self(letters)
        two, three = np.roll(one, 1, axis=1), np.roll(one, 2, axis=1)
        at = lambda x: np.searchsorted(letters, x)
        return (three[at(grams >> 42)] * two[at(grams >> 21 & 0x1FFFFF)] * one[at(grams & 0x1FFFFF)]).astype(np.float32)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Packed trigrams of the whole text and their counts; none if it has no letter."""
    if not text:
        return _NONE
    parts = []
    table, before = _letters(), np.zeros(1, np.int64)
    for a in range(0, len(text), _PIECE):
        codes = np.frombuffer(text[a : a + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        x = np.concatenate([before, table[codes]] + ([np.zeros(1, np.int64)] if a + _PIECE >= len(text) else []))
        x = x[np.r_[True, (x[1:] != 0) | (x[:-1] != 0)]]
        if len(x) >= 3:
            parts.append(np.unique((x[:-2] << 42) | (x[1:-1] << 21) | x[2:], return_counts=True))
        before = x[-2:]
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return _NONE
    grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


_NONE = (np.empty(0, np.int64), np.empty(0, np.int64))


def _bundles(texts: list, vectors: LetterVectors) -> np.ndarray:
    """One vector per text."""
    out = np.zeros((len(texts), vectors.dim), np.float32)
    found = [trigrams(t) for t in texts]
    every = np.unique(np.concatenate([g for g, _ in found])) if found else _NONE[0]
    for k in range(0, len(every), _GRAMS):
        part = every[k : k + _GRAMS]
        table = vectors.grams(part)
        for i, (grams, counts) in enumerate(found):
            a, b = np.searchsorted(grams, part[0]), np.searchsorted(grams, part[-1], side="right")
            if a < b:
                out[i] += counts[a:b].astype(np.float32) @ table[np.searchsorted(part, grams[a:b])]
    return out


def learn(docs: DataFrame, dim: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototypes by language, from all rows of ``docs`` (text, lang) that have both."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums = LetterVectors(dim), {}
        for batch in batches:
            by: dict = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                grams, counts = trigrams(text)
                if len(grams):
                    by.setdefault(lang, []).append((grams, counts / np.sqrt((counts * counts).sum())))
            for lang, found in by.items():
                every, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([c for _, c in found]))
                own = sums.setdefault(lang, np.zeros(dim))
                for a in range(0, len(every), _GRAMS):
                    own += counts[a : a + _GRAMS] @ vectors.grams(every[a : a + _GRAMS])
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dim, "at": np.arange(dim, dtype=np.int32), "x": v})

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    summed = rows.mapInArrow(bundle, "lang string, at int, x double").groupBy("lang", "at").agg(F.sum("x").alias("x")).toPandas()
    return {lang: g.sort_values("at")["x"].to_numpy() for lang, g in summed.groupby("lang")}


def _contrast(prototypes: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, unit prototypes less what they share, and the unit shared part."""
    names = sorted(prototypes)
    unit = np.stack([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names])
    common = unit.mean(axis=0)
    common /= np.linalg.norm(common) or 1
    if len(names) == 1:
        return names, unit.astype(np.float32), np.zeros_like(common, np.float32)
    rest = unit - np.outer(unit @ common, common)
    return names, (rest / np.maximum(np.linalg.norm(rest, axis=1, keepdims=True), 1e-12)).astype(np.float32), common.astype(np.float32)


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIMENSIONS) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, at least 0), plus the held_out column of ``docs``."""
    names, unit, common = _contrast(prototypes) if prototypes else ([], None, None)
    model = docs.sparkSession.sparkContext.broadcast((unit, common))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = LetterVectors(dim)
        unit, common = model.value
        for whole in batches:
            for a in range(0, whole.num_rows, _DOCS):
                batch = whole.slice(a, _DOCS)
                lang, best = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                if names:
                    x = _bundles(batch["text"].to_pylist(), vectors)
                    has = np.abs(x).max(axis=1) > 0
                    x -= np.outer(x @ common, common)
                    cos = (x @ unit.T) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
                    top = cos.argmax(axis=1)
                    lang = [names[t] if h else UNKNOWN for t, h in zip(top, has, strict=True)]
                    best = np.where(has, np.clip(cos[np.arange(len(top)), top], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(lang, pa.string()), pa.array(best.astype(float))], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that aren't held out."""
    tagged = docs.withColumn("held_out", held_out(5, 0))
    return predict(tagged, learn(tagged.where("not held_out")))
