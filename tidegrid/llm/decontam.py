"""Which words of documents lie in passages of a benchmark: a prefix-filtered join of word windows.

A window is a run of words of an item, as many as the item has or ``window`` at most. A document holds a window only
if it holds all of its shingles, so one shingle is enough to look for: the rarest, by its count in all documents.
The documents are read once. Where a shingle of any item begins, the place and the words around it are kept. These
few rows give the counts, are joined with the windows on their rarest shingle, are bounded by the place of that
shingle in the window, and are compared word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import lower_ascii, stored

WINDOW = 10
SHINGLE = 4
BLOCK = 200_000  # shingles of items that are sent to every task at once; more are looked for in several reads
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The lower-cased words; a null text has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), APART), "")


def shingle_from(place: Column, k: int) -> Column:
    """The hash of the ``k`` words of ``words`` from ``place`` (from 0) on."""
    return F.xxhash64(*[F.get("words", place + i) for i in range(k)])


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``item, words``: the windows of every item, each once. ``items`` has ``item, words``."""
    size = F.size("words")
    start = F.explode(F.sequence(F.lit(1), F.greatest(size - window + 1, F.lit(1)))).alias("start")
    rows = items.filter(size > 0).select("item", "words", start)
    return rows.select("item", F.slice("words", F.col("start"), F.lit(window)).alias("words")).distinct()


def near_shingles(docs: DataFrame, shingles: DataFrame, k: int, window: int) -> DataFrame:
    """``doc, n_words, place, shingle, around, at``: where documents hold one of ``shingles``.

    ``around`` are the words near the place, as many as any window over the shingle can have; the shingle begins
    at word number ``at`` of them. Besides, every document has one row without a shingle.
    """
    rows = docs.select("doc", "words", F.posexplode_outer("words").alias("place", "word"))
    rows = rows.select("doc", "words", "place", shingle_from(F.col("place"), k).alias("shingle"))
    rows = rows.join(F.broadcast(shingles.withColumn("known", F.lit(True))), "shingle", "left")
    first = F.coalesce("place", F.lit(0)) == 0
    rows = rows.filter(F.col("known") | first)
    back = F.least(F.col("place"), F.lit(window - k))
    about = F.struct("place", "shingle", F.slice("words", F.col("place") - back + 1, F.lit(2 * window - k)).alias("around"), (back + 1).alias("at"))
    found = F.when(F.col("known"), F.array(about))
    both = F.when(first, F.concat(F.array(F.lit(None).cast(found_type())), F.coalesce(found, F.array().cast(f"array<{found_type()}>")))).otherwise(found)
    rows = rows.select("doc", F.size("words").cast("bigint").alias("n_words"), F.explode(both).alias("near"))
    return rows.select("doc", "n_words", "near.*")


def found_type() -> str:
    return "struct<place:int,shingle:bigint,around:array<string>,at:int>"


def window_hits(docs: DataFrame, windows: DataFrame, window: int, shingle: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Every document with its number of words, and every place where a window occurs: ``doc, start, words``."""
    sets = stored(windows.select("words").distinct(), "decontam-windows")
    length = F.least(F.size("words"), F.lit(shingle))
    lengths = [k for (k,) in sets.select(length).distinct().collect()]  # ``shingle`` numbers at most
    counted, found = None, []
    for k in sorted({*lengths, shingle}, reverse=True):
        own = sets.filter(length == k)
        place = F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("place_in")
        own = own.select("words", place).select("words", "place_in", shingle_from(F.col("place_in"), k).alias("shingle"))
        tokens = stored(own.select("shingle").distinct(), "decontam-shingles")
        blocks = max(1, -(-tokens.count() // block))
        for b in range(blocks):
            part = tokens.filter(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == b)
            near = stored(near_shingles(docs, part, k, window), "decontam-near")
            counted = near.filter("shingle is null").select("doc", "n_words") if counted is None else counted
            found.append((own, near.filter("shingle is not null")))
    hits = []
    for own in {id(o): o for o, _ in found}.values():
        near = reduce(DataFrame.unionAll, [n for o, n in found if o is own])
        hits.append(verified(own, near))
    return counted, reduce(DataFrame.unionAll, hits)


def verified(own: DataFrame, near: DataFrame) -> DataFrame:
    """Windows that occur at a place, looked for by their rarest shingle. A window with an unseen shingle cannot occur."""
    counts = near.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    ranked = own.join(counts, "shingle", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    prefix = ranked.groupBy("words").agg(F.min(F.struct("times", "shingle", "place_in")).alias("rare"))
    prefix = prefix.filter("rare.times > 0").select("words", "rare.shingle", "rare.place_in")
    first, size = F.col("at") - F.col("place_in"), F.size("words")
    met = near.join(prefix, "shingle").filter((first >= 1) & (first + size - 1 <= F.size("around")))
    met = met.filter(F.slice("around", first, size) == F.col("words"))
    return met.select("doc", (F.col("place") - F.col("place_in")).alias("start"), "words")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A word is hit if it lies in an occurrence of a window of any item; ``n_items`` counts the items with occurring
    windows, whose ids are sorted as text, joined with commas and hashed. Null texts have no words, an item
    without words has no windows, and no items leave every document clean. A null item id counts as the empty
    text. Rows that repeat an id are judged apart unless their texts are equal, when each gets the same
    result. Other columns are ignored. What is sent to every task are at most about ``block`` shingles.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text")).alias("doc"),
        words_of(F.col(text_col)).alias("words"),
    )
    own = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(item_text_col)).alias("words"))
    windows = stored(item_windows(own, window), "decontam-items")
    counted, hits = window_hits(rows, windows, window, min(shingle, window), block)
    hits = stored(hits.distinct(), "decontam-hits")
    end = F.col("start") + F.size("words")
    before = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    spans = hits.select("doc", "start", end.alias("end")).distinct()
    spans = spans.withColumn("new", F.greatest(F.col("end") - reached, F.lit(0)))
    words = spans.groupBy("doc").agg(F.sum("new").alias("n_hit"))
    named = hits.select("doc", "words").distinct().join(windows, "words").select("doc", "item").distinct()
    named = named.groupBy("doc").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    about = counted.join(words, "doc", "left").join(named, "doc", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return about.select(
        "doc.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
