"""Public tokenizers: where their vocabularies are, and encoders that remember the parts of texts they have met."""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Callable
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO, MEMO_CHARS = 300_000, 40  # parts a process remembers, and as many it may still come back to; the longest of them
# White space but for space and line end, as Python and the tokenizers see it.
BLANKS = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LOT_CHARS = 6_000_000  # text split into parts at once, more only where a single text is longer


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def once_a_process(key: tuple, make: Callable):
    """What ``make()`` gives, made once in this Python process and shared by the tasks that run in it.

    Functions travel to the tasks by value, and their modules with them, so a global of a module would not be
    shared.
    """
    kept = sys.modules.setdefault("tidegrid_of_this_process", types.ModuleType("tidegrid_of_this_process"))
    known = vars(kept).setdefault("made", {})
    if key not in known:
        known[key] = make()
    return known[key]


class ByteEncoder:
    """Token ids of texts by a byte-level BPE that splits texts into words with the space before them.

    Such a tokenizer never joins what lies on two sides of a space between two characters that are no white space,
    and a line end between two such is a token of its own. So a text is split there, each different part is encoded
    once, and new parts are encoded together, as the lines of one text. ``kind`` is the type of the ids.
    """

    between = re.compile(r"(?<=\S) (?=\S)")
    uneven = re.compile(r"\s\s|\A\s|\s\Z")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.line_end = self._whole(["\n"])[0]
        # By part, the space before it not shown; the first part of a text has a line end before it that is not there.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def is_even(self, text: str) -> bool:
        """Is all white space single spaces and line ends between other characters?"""
        if "  " in text or text[:1].isspace() or text[-1:].isspace() or any(map(text.__contains__, BLANKS)):
            return False
        return "\n" not in text or not (" \n" in text or "\n " in text or "\n\n" in text)

    def uneven_parts(self, text: str) -> list[str]:
        """The parts of any text, as keys of ``known``."""
        first, *others = self.between.split(text)
        return ["\n" + first, *others]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, self.kind).tobytes() for encoding in found]

    def _lines(self, lines: list[str]) -> list[bytes]:
        """Ids of lines that are even, but for one space at the start."""
        raw, size = self._whole(["\n".join(lines)])[0], len(self.line_end)
        ends = np.flatnonzero(np.frombuffer(raw, self.kind) == np.frombuffer(self.line_end, self.kind)[0]) * size
        if len(ends) != len(lines) - 1:
            return self._whole(lines)
        return [raw[a:b] for a, b in zip([0, *(ends + size).tolist()], [*ends.tolist(), len(raw)])]

    def _new(self, parts: set[str]) -> dict[str, bytes]:
        plain = [part for part in parts if part.isprintable() and not part.endswith(" ")]
        found = dict(zip(plain, self._lines([" " + part for part in plain]))) if plain else {}
        others = parts.difference(plain)
        firsts = [part for part in others if part[0] == "\n"]
        whole = [part for part in others if part[0] != "\n" and self.uneven.search(part)]
        split = {part: (" " + part).split("\n") for part in others.difference(firsts, whole)}
        lines = list(set().union(*split.values()))
        of_line = dict(zip(lines, self._lines(lines))) if lines else {}
        found.update((part, self.line_end.join(map(of_line.__getitem__, own))) for part, own in split.items())
        texts = [part[1:] for part in firsts] + [" " + part for part in whole]
        found.update(zip(firsts + whole, self._whole(texts)))
        return found

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """The ids of different parts, remembered or new."""
        if len(self.known) > MEMO:
            self.known, self.before = {}, self.known
        missing = set(filterfalse(self.known.__contains__, parts))
        again = missing & self.before.keys()
        self.known.update((part, self.before[part]) for part in again)
        found = self._new(missing - again)
        self.known.update(found)
        out = list(map(self.known.__getitem__, parts))
        for part in found:
            if len(part) > MEMO_CHARS:  # long parts are forgotten
                del self.known[part]
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Parts are counted and numbered by Arrow, each different one is looked up, and numpy puts their ids in a row."""
        if all(map(self.is_even, texts)):
            lists = pc.split_pattern(pa.array(["\n" + text for text in texts], pa.large_string()), " ")
        else:
            lists = pa.array([("\n" + text).split(" ") if self.is_even(text) else self.uneven_parts(text) for text in texts], pa.large_list(pa.large_string()))
        parts, ends = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
        ids = self._ids_of(parts.dictionary.to_pylist())
        numbers, size = parts.indices.to_numpy(), len(self.line_end)
        every = np.frombuffer(b"".join(ids), self.kind)
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // size
        starts = np.cumsum(counts) - counts
        lengths = counts[numbers]
        upto = np.concatenate(([0], np.cumsum(lengths)))
        shift = (starts[numbers] - upto[:-1]).astype(np.int32)
        row = every[np.repeat(shift, lengths) + np.arange(upto[-1], dtype=np.int32)].tobytes()
        bounds = (upto[ends] * size).tolist()
        return [row[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]):
        """The ids of each text, as bytes of ``kind``, in their order."""
        lot, chars = [], 0
        for text in texts:
            lot.append(text)
            chars += len(text)
            if chars >= LOT_CHARS:
                yield from self._encode(lot)
                lot, chars = [], 0
        if lot:
            yield from self._encode(lot)


def byte_encoder(path: str) -> ByteEncoder:
    return once_a_process(("byte", path), lambda: ByteEncoder(path))
