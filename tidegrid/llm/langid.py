"""Language identification with hyperdimensional letter vectors.

Every letter has a random vector of +1 and -1. The letters of an n-gram are bound by multiplying their
vectors, each permuted (rotated) by its place; the n-grams of a text are bundled by adding. A
language is the bundle of its labelled texts, and a text gets the language whose vector has the
largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSIONS = 1024
ORDER = 3
ROWS = 4096  # letter vectors; letters whose code points agree modulo ROWS share one
SEED = 20240229
MAX_LANGUAGES = 1000
CHUNK = 1 << 20  # letters of one text that are counted at once
UNKNOWN = "und"


@lru_cache(maxsize=4)
def letter_vectors(dimensions: int, order: int) -> list[np.ndarray]:
    """The vectors of all letters, one table per place in an n-gram; row 0 is the gap between words."""
    base = np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(ROWS, dimensions))
    return [np.ascontiguousarray(np.roll(base, place, axis=1)) for place in range(order)]


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the lower-cased text as codes, and how often each occurs; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.where(is_letter, points % (ROWS - 1) + 1, 0).astype(np.int64)
    gap = codes == 0
    codes = codes[~(gap & np.concatenate(([True], gap[:-1])))]  # one gap between words, none in front
    codes = np.concatenate(([0], codes, [0] * (order - 1)))
    total: dict[int, int] = {}
    parts = []
    for start in range(0, len(codes) - order + 1, CHUNK):
        piece = codes[start : start + CHUNK + order - 1]
        grams = np.zeros(len(piece) - order + 1, dtype=np.int64)
        for place in range(order):
            grams = grams * ROWS + piece[place : place + len(grams)]
        parts.append(np.unique(grams, return_counts=True))
    if len(parts) == 1:
        return parts[0]
    for grams, counts in parts:
        for g, c in zip(grams.tolist(), counts.tolist()):
            total[g] = total.get(g, 0) + c
    return np.array(list(total), dtype=np.int64), np.array(list(total.values()), dtype=np.int64)


def bundle(grams: np.ndarray, counts: np.ndarray, dimensions: int, order: int) -> np.ndarray:
    """The sum of the n-grams' vectors."""
    tables = letter_vectors(dimensions, order)
    out = np.zeros(dimensions, dtype=np.float64)
    for start in range(0, len(grams), 8192):
        rest = grams[start : start + 8192]
        bound = None
        for place in range(order - 1, -1, -1):
            vectors = tables[place][rest % ROWS]
            bound = vectors if bound is None else bound * vectors
            rest = rest // ROWS
        out += counts[start : start + 8192].astype(np.float32) @ bound.astype(np.float32)
    return out


def language_vectors(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, order: int = ORDER
) -> dict[str, np.ndarray]:
    """A unit vector per language, from all rows of ``docs`` that have a text and a language.

    Each task counts n-grams and sends one vector per language it met; the sums are whole numbers, so the order
    of tasks does not show. What all languages have in common is taken off. Languages are labels, at
    most MAX_LANGUAGES of them; more are an error.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, dict[int, int]] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                counts = seen.setdefault(lang, {})
                for g, c in zip(*(x.tolist() for x in gram_counts(text, order))):
                    counts[g] = counts.get(g, 0) + c
        for lang, counts in seen.items():
            if counts:
                grams = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
                times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                whole = np.zeros(dimensions, dtype=np.int64)
                tables = letter_vectors(dimensions, order)
                for start in range(0, len(grams), 8192):
                    rest, bound = grams[start : start + 8192], 1
                    for place in range(order - 1, -1, -1):
                        bound = bound * tables[place][rest % ROWS].astype(np.int64)
                        rest = rest // ROWS
                    whole += times[start : start + 8192] @ bound
                yield pd.DataFrame({"lang": [lang], "vector": [whole]})

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    sums = (
        rows.mapInPandas(partial, "lang string, vector array<bigint>")
        .select("lang", F.posexplode("vector").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector"))
    )
    found = sums.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    vectors = {r["lang"]: np.array([x["value"] for x in r["vector"]], dtype=np.float64) for r in found}
    vectors = {lang: v / max(np.linalg.norm(v), 1e-12) for lang, v in sorted(vectors.items())}
    if len(vectors) > 1:
        common = sum(vectors.values()) / len(vectors)
        vectors = {lang: v - common for lang, v in vectors.items()}
    return {lang: v / max(np.linalg.norm(v), 1e-12) for lang, v in vectors.items()}


def predict_language(
    docs: DataFrame, vectors: dict[str, np.ndarray], text_col: str = "text", order: int = ORDER
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with that language, negative ones as 0.

    A text that is null or has no letter gets ``und`` and 0, and so does every text when no
    language was learned. Of languages with equal cosines the first by name is taken. Whole texts are read; columns
    of ``docs`` with these two names are replaced.
    """
    names = sorted(vectors)
    matrix = np.stack([vectors[n] for n in names]) if names else None
    out = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(out)
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            langs, scores = [], []
            for text in batch:
                grams, counts = gram_counts(text, order) if text and names else ((), ())
                if len(grams) == 0:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                own = bundle(grams, counts, matrix.shape[1], order)
                cosines = matrix @ own / max(np.linalg.norm(own), 1e-12)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    found = docs.withColumn("__language", predicted(F.col(text_col)))
    found = found.drop("lang_pred", "score")
    return found.select("*", "__language.lang_pred", "__language.score").drop("__language")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: one in four by the checksum of its id; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, learned from the rows that are not held out.

    The label, the source and the id are used for choosing what to learn from and for nothing else.
    """
    rows = docs.withColumn("held_out", held_out(id_col))
    return predict_language(rows, language_vectors(rows.filter(~F.col("held_out")), text_col, lang_col), text_col)
