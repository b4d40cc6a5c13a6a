"""Fill-in-the-middle: texts cut into prefix, middle and suffix between units, and put together again.

One ``fullmatch`` of ``(unit)*`` in the ``regex`` library, which remembers every repetition of a group, gives
the end of each unit at once: their number and the places of both cuts are read from ``match.ends(1)``. What is
drawn, cut, joined and hashed besides are built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LETTERS = "A-Za-z"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 500_000  # code points matched at once; the captures of a longer text would not fit in the library's memory
PLAIN_PERCENT, SPM_PERCENT = 90, 20


def unit_ends(text: str, block: int = BLOCK) -> np.ndarray:
    """Where each unit (a run of ASCII letters, or one other character) ends, in code points.

    A text of more than ``block`` code points is matched piece by piece. A piece ends behind a character that is
    no letter, or behind the run of letters that reaches beyond it, so the units are those of the whole text.
    """
    import regex

    units = regex.compile(f"([{LETTERS}]++|[^{LETTERS}])*+")
    last_other, next_other = regex.compile(f"(?r)[^{LETTERS}]"), regex.compile(f"[^{LETTERS}]")
    found, start = [np.zeros(0, np.int64)], 0
    while start < len(text):
        end = len(text)
        if end - start > block:
            other = last_other.search(text, start, start + block)
            if other is None:
                other = next_other.search(text, start + block)
                end = other.start() if other else end
            else:
                end = other.end()
        found.append(np.array(units.fullmatch(text, start, end).ends(1), np.int64))
        start = end
    return np.concatenate(found)


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in ("n", "first", "second")]))
def _cuts(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, one, other in parts:
        rows = []
        for text, a, b in zip(texts, one, other):
            ends = unit_ends(text)
            n = len(ends)
            low, high = sorted((int(a) % (n + 1), int(b) % (n + 1)))
            rows.append((n, int(ends[low - 1]) if low else 0, int(ends[high - 1]) if high else 0))
        yield pd.DataFrame(rows, columns=["n", "first", "second"], dtype="int64")


def draws(key: Column, count: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers drawn from a key: the first groups of eight digits of its SHA-256."""
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``n`` counts the units of the text. Two of its n + 1 cuts are drawn from seed and id; they may be equal, so that
    any part may be empty. ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix first) or ``plain``, which is
    the text as it is: for texts that are empty or hold a marker and for a tenth of the others. Lengths are in
    code points, null for plain.

    A null text is empty. Of equal rows each gives the same; a null id draws from the seed alone. A text is held whole
    by one task. Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumns({f"_h{i + 1}": h for i, h in enumerate(draws(key))})
    rows = rows.withColumn("_cut", _cuts("_text", "_h1", "_h2"))
    text = F.col("_text")
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(marker))
    plain = (text == "") | marked | (F.col("_h3") % 100 >= PLAIN_PERCENT)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < SPM_PERCENT, "spm").otherwise("psm")
    rows = rows.select("doc_id", "_text", F.col("_cut.n").alias("n"), F.col("_cut.first").alias("_first"), F.col("_cut.second").alias("_second"), form.alias("form"))
    first, second = F.col("_first").cast("int"), F.col("_second").cast("int")
    prefix = F.substr(text, F.lit(1), first)
    middle = F.substr(text, first + 1, second - first)
    suffix = F.substr(text, second + 1)
    cut = F.col("form") != "plain"
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.when(cut, F.col("_first")).alias("prefix_chars"),
        F.when(cut, F.col("_second") - F.col("_first")).alias("middle_chars"),
        output.alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` made ``output`` of.

    No part holds a marker, and none can arise where a part meets one, so the first of each is the one put there.
    """

    def split(second: str) -> tuple[Column, Column, Column]:
        at = F.locate(second, output, len(PREFIX) + 1)
        end = F.call_function("locate", F.lit(MIDDLE), output, at + len(second))
        one = F.substr(output, F.lit(len(PREFIX) + 1), at - len(PREFIX) - 1)
        other = F.substr(output, at + len(second), end - at - len(second))
        return one, other, F.substr(output, end + len(MIDDLE))

    prefix, suffix, middle = split(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = split(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
