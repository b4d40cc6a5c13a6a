"""Licence texts in documents: MinHash bands over overlapping windows, checked by exact containment.

Texts are cut into windows of shingles, twice as long as a template and beginning at every multiple of its length, so
that a stretch as long as the template lies within one. Lengths are powers of two, so a window has less than four times
the shingles of its template. Windows and templates get the smallest of their shingles'
hashes under each of BANDS functions, a band of one row each. A window is a candidate for the templates it shares a
band with. A window that holds a share SHARE of a template's shingles has a similarity of at least
SHARE / (5 - SHARE) with it, so it is missed with a chance of (1 - SHARE / (5 - SHARE)) ** BANDS at most: below 5e-6. In
candidates, the shingles are compared exactly.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.jaccard import U64, mixed, text_words

WORDS = 5
SHARE = 0.75
BANDS = 64
TOGETHER = 1 << 16  # words hashed together, so that they stay in the processor's cache
MOST_SHINGLES = 1_000_000  # of all templates together; they are sent to every task

SHORT = 64  # shingles; templates up to here are looked for together

# Short mentions of licences; below, their full texts and the notices that are put into files.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted",
}
PUBLISHED = ["Apache-2.0", "BSD-3-Clause", "GPL-2", "GPL-3", "ISC", "LGPL-2.1", "LGPL-3", "MIT", "MPL-2.0"]
NOTICES = ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3"]


def shipped(file: str) -> str:
    return pkgutil.get_data("tidegrid.llm", f"license_texts/{file}.txt").decode("utf-8")


TEMPLATES |= {f"{name} text": shipped(name) for name in PUBLISHED}
TEMPLATES |= {f"{name} notice": shipped(f"{name}-notice") for name in NOTICES}

MARK = r"[!-/:-@\[-`{-~\u2010-\u2027\u00a9]"
# A run of marks is looked at once, from its start, and never given up piece by piece: linear in any text.
AROUND = re.compile(rf"(?<!{MARK}){MARK}++(?![^ \t-\r])|(?<![^ \t-\r]){MARK}++")


def bare_words(text: str | None) -> np.ndarray:
    """The hashes of the words without the punctuation around them; punctuation alone is no word."""
    return text_words(AROUND.sub("", text)) if text else np.empty(0, np.uint64)


def gram_list(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from every place on; of fewer words, one hash of all."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for place in range(size):
        total = total + words[place : place + len(total)] * U64(pow(0xD6E8FEB86659FD93, place + 1, 1 << 64))
    return mixed(total)


def band_salts(bands: int) -> np.ndarray:
    """Odd numbers; hashes multiplied by one of them are in a new order."""
    return np.random.default_rng(3).integers(0, 1 << 64, bands, dtype=np.uint64) | U64(1)


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    share: float = SHARE,
    bands: int = BANDS,
) -> DataFrame:
    """``doc_id, license, first_word, n_words, containment`` for every stretch of a text that holds a template.

    Words are split at white space, without the punctuation around them, and A-Z count as a-z; punctuation alone is no
    word, so comment signs before lines do no harm. A template of fewer than ``words`` words is one shingle of all
    of them. ``containment`` is the share of the template's distinct shingles in the stretch, at least ``share``;
    a stretch starts and ends with such a shingle and is at most twice as long as the template. Of overlapping
    stretches of one template the first is given, of those that start together the fullest. Null and empty texts hold nothing; a template
    without a word is an error, and so are templates of more than MOST_SHINGLES shingles. Rows that repeat give
    repeated results. Other columns are ignored.
    """
    salts = band_salts(bands)
    by_shape: dict[tuple[int, int], list] = {}
    for name, text in sorted(templates.items()):
        found = bare_words(text)
        if len(found) == 0:
            raise ValueError(f"template {name} has no words")
        size = min(words, len(found))
        grams = gram_list(found, size)
        length = 1 << (len(grams) - 1).bit_length()  # templates of about one length share windows
        by_shape.setdefault((size, length), []).append((name, np.unique(grams)))
    if sum(len(own) for group in by_shape.values() for _, own in group) > MOST_SHINGLES:
        raise ValueError(f"more than {MOST_SHINGLES} shingles in templates")
    least_of = {
        shape: [[int((own * salt).min()) for _, own in group] for salt in salts] for shape, group in by_shape.items()
    }

    def candidates(texts: list[np.ndarray], lengths: list[tuple[int, int]]) -> list[set[tuple[int, int, int]]]:
        """Per text the first shingle of a window, its length and the number of a template of that length, where they share a band.

        The texts lie in one array, each followed by at least one longest block of the largest hash, so that every
        length divides the place of a text and no window joins two of them. Minima of blocks come from those of half as long ones.
        """
        longest = max(length for _, length in lengths)
        sizes = np.array([len(grams) for grams in texts])
        places = np.concatenate(([0], np.cumsum(-(-sizes // longest) * longest + longest)))
        laid = np.zeros(places[-1], dtype=np.uint64)
        empty = np.ones(places[-1], dtype=bool)
        for grams, place in zip(texts, places):
            laid[place : place + len(grams)] = grams
            empty[place : place + len(grams)] = False
        found = [set() for _ in texts]
        for band, salt in enumerate(salts):
            least, length = laid * salt, 1
            least[empty] = ~U64(0)
            while True:
                for shape in (x for x in lengths if x[1] == length):
                    window = np.minimum(least[:-1], least[1:])
                    for number, value in enumerate(least_of[shape][band]):
                        starts = np.flatnonzero(window == U64(value)) * length
                        owners = np.searchsorted(places, starts, side="right") - 1
                        for owner, start in zip(owners.tolist(), (starts - places[owners]).tolist()):
                            if start < sizes[owner]:
                                found[owner].add((start, length, number))
                if length == longest:
                    break
                least, length = np.minimum(least[::2], least[1::2]), 2 * length
        return found

    def stretch(grams: np.ndarray, start: int, length: int, own: np.ndarray) -> tuple | None:
        """How much of a template a window holds, and between which shingles; None if it is too little."""
        part = grams[start : start + 2 * length]
        hits = np.flatnonzero(own[np.minimum(np.searchsorted(own, part), len(own) - 1)] == part)
        if len(hits) == 0:
            return None
        have = len(np.unique(part[hits])) / len(own)
        return (have, start + int(hits[0]), start + int(hits[-1])) if have >= share else None

    def matches(texts: list[np.ndarray]) -> list[list[tuple[str, int, int, float]]]:
        """Per text, given as its words, the templates it holds: name, first word, number of words, share."""
        hits = [{} for _ in texts]
        # Long templates are looked for one length at a time, and only in texts that can hold enough of them.
        groups = {}
        for shape in by_shape:
            groups.setdefault((shape[0], max(shape[1], SHORT)), []).append(shape)
        for (size, _), lengths in groups.items():
            least = min(share * len(own) for shape in lengths for _, own in by_shape[shape])
            long_enough = [i for i, words in enumerate(texts) if len(words) - size + 1 >= max(1, least)]
            grams = [gram_list(texts[i], size) for i in long_enough]
            for i, own_grams, windows in zip(long_enough, grams, candidates(grams, lengths) if grams else []):
                for start, length, number in windows:
                    name, own = by_shape[size, length][number]
                    if place := stretch(own_grams, start, length, own):
                        hits[i].setdefault(name, []).append((place, size))
        return [list(separate(own)) for own in hits]

    def separate(hits: dict[str, list]) -> Iterator[tuple[str, int, int, float]]:
        """Of overlapping stretches of one template, the first."""
        for name, places in sorted(hits.items()):
            end = -1
            for (have, first, last), size in sorted(places, key=lambda h: (h[0][1], -h[0][0], h[0][2])):
                if first > end:
                    yield name, first, last - first + size, have
                    end = last

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, ids, texts, held = [], [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids.append(doc_id)
                texts.append(bare_words(text))
                held += len(texts[-1])
                if held > TOGETHER:
                    rows += [(i, *hit) for i, hits in zip(ids, matches(texts)) for hit in hits]
                    ids, texts, held = [], [], 0
            rows += [(i, *hit) for i, hits in zip(ids, matches(texts)) for hit in hits]
            yield pd.DataFrame(rows, columns=["doc_id", "license", "first_word", "n_words", "containment"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, license string, first_word bigint, n_words bigint, containment double"
    return rows.mapInPandas(scanned, schema)
