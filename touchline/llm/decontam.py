"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index holds the postings (term, document, position) of the training texts for the terms that a search needs: each
benchmark window is looked up by its two rarest terms in the corpus. Positions are adjusted by the term's offset in the
window, so that a window's two lists intersect where both terms stand where the window would have them; what is left is
compared word by word with the document. Proximity search uses the same postings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import ascii_lower, keyed_rows, small, staged

#: What tells windows apart: items that share an id but not the text have several with the same position.
WINDOW = ["item", "i", "h"]


def word_list(text: Column) -> Column:
    """Words of the lower-cased (A-Z) text: runs of characters other than ASCII without letters and digits."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``item, i, h, w, words``: each item's windows of ``window`` words; an item of fewer words is one window.

    ``h`` is a hash of the words.
    """
    words = items.select(F.col(id_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("all")).where("item is not null and size(all) > 0")
    w = F.least(F.size("all"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(0), F.size("all") - w))
    windows = words.select("item", "all", w.alias("w"), starts.alias("i")).select("item", "i", "w", F.slice("all", F.col("i") + 1, F.col("w")).alias("words"))
    return windows.select("item", "i", F.xxhash64("words").alias("h"), "w", "words").distinct()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keyed_rows(docs, id_col, text_col).select("__id", F.col("__tie").alias("__th"), "__text")


def term_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of ``terms`` occurs in all texts; 0 for those that don't."""
    seen = rows.select(F.explode(word_list(F.col("__text"))).alias("term")).join(small(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def postings(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: ``term, __id, __th, pos`` for the given terms."""
    exploded = rows.select("__id", "__th", F.posexplode(word_list(F.col("__text"))).alias("pos", "term"))
    return staged(exploded.join(small(terms), "term").select("term", "__id", "__th", "pos"), "postings")


def phrase_candidates(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """``__id, __th, item, i, h, start``: where the two rarest terms of a window stand as in the window."""
    parts = windows.select(*WINDOW, F.posexplode("words").alias("offset", "term"))
    counts = staged(term_counts(rows, staged(parts.select("term").distinct(), "terms")), "term-counts")
    rank = F.row_number().over(Window.partitionBy(*WINDOW).orderBy("n", "term", "offset"))
    rarest = staged(parts.join(counts, "term").select(*WINDOW, "offset", "term", "n", rank.alias("rank")).where("rank <= 2 and n > 0"), "rarest")
    index = postings(rows, staged(rarest.select("term").distinct(), "rare-terms"))

    def adjusted(k: int) -> DataFrame:
        own = staged(rarest.where(F.col("rank") == k).select("term", *WINDOW, "offset"), "lists")
        return index.join(small(own), "term").select("__id", "__th", *WINDOW, (F.col("pos") - F.col("offset")).alias("start")).where("start >= 0")

    single = staged(windows.where("w = 1").select(*WINDOW), "single")
    first = adjusted(1)
    second = adjusted(2).select(F.col("__id").alias("__id2"), F.col("__th").alias("__th2"), F.col("item").alias("item2"), F.col("i").alias("i2"), F.col("h").alias("h2"), F.col("start").alias("start2")).distinct()
    same = F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__th") == F.col("__th2")) & (F.col("item") == F.col("item2")) & (F.col("i") == F.col("i2")) & (F.col("h") == F.col("h2")) & (F.col("start") == F.col("start2"))
    both = first.distinct().join(second, same).select(*first.columns)
    return both.unionByName(first.join(small(single), WINDOW).select(*first.columns).distinct())


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """``__id, __th, n_words, n_hit, items`` per row."""
    rows = _rows(docs, id_col, text_col)
    windows = staged(item_windows(benchmark, window, item_col, item_text), "windows")
    found = phrase_candidates(rows, windows).join(small(windows), WINDOW)
    found = found.groupBy("__id", "__th").agg(F.collect_list(F.struct("item", "start", "w", "words")).alias("found"))
    found = found.select(F.col("__id").alias("__fid"), F.col("__th").alias("__fth"), "found")
    joined = rows.join(found, F.col("__id").eqNullSafe(F.col("__fid")) & (F.col("__th") == F.col("__fth")), "left")
    own = joined.select("__id", "__th", word_list(F.col("__text")).alias("__words"), "found")
    exact = F.filter(F.coalesce("found", F.array().cast(found.schema["found"].dataType)), lambda c: F.slice("__words", c["start"] + 1, c["w"]) == c["words"])
    own = own.select("__id", "__th", F.size("__words").cast("long").alias("n_words"), exact.alias("exact"))
    hit = F.size(F.array_distinct(F.flatten(F.transform("exact", lambda c: F.sequence(c["start"], c["start"] + c["w"] - 1))))).cast("long")
    items = F.array_sort(F.array_distinct(F.transform("exact", lambda c: c["item"])))
    return own.select("__id", "__th", "n_words", hit.alias("n_hit"), items.alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row: ``id_col, n_words, n_hit, n_items, items_sha256, contaminated, items``.

    A word is hit if it lies in an occurrence of a benchmark window; ``items`` are the ids of items with such a window,
    as strings in order. Items that share an id are searched with the text of each. Null and empty texts have no words and items without words no windows; items without an id are left
    out. Rows that share an id are judged on their own text. An empty benchmark hits nothing.
    """
    own = _judged(docs, benchmark, window, id_col, text_col, item_col, item_text)
    return own.select(F.col("__id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, without an occurrence of a benchmark window in their text."""
    hit = staged(_judged(docs, benchmark, window, id_col, text_col, item_col, item_text).where("n_hit > 0").select("__id", "__th").distinct(), "contaminated")
    hit = hit.select(F.col("__id").alias("__hid"), "__th")
    rows = keyed_rows(docs, id_col, text_col, whole=True)
    return rows.join(small(hit), F.col("__id").eqNullSafe(F.col("__hid")) & (F.col("__tie") == F.col("__th")), "left_anti").select("__row.*")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, terms: int = 3, within: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id_col, item, first, last``: documents where an item's ``terms`` rarest terms, in any order, lie around an occurrence
    of the rarest one, at most ``within`` words before or after it. ``first`` and ``last`` are the nearest such stretch.

    Null and empty texts match nothing, items without an id or words are left out, rows that share an id are judged by their own text, and
    rows alike in both give one match."""
    rows = _rows(docs, id_col, text_col)
    parts = benchmark.select(F.col(item_col).cast("string").alias("item"), F.explode(F.array_distinct(word_list(F.col(item_text)))).alias("term")).where("item is not null")
    counts = staged(term_counts(rows, staged(parts.select("term").distinct(), "terms")), "term-counts")
    rank = F.row_number().over(Window.partitionBy("item").orderBy("n", "term"))
    rare = staged(parts.join(counts, "term").select("item", "term", rank.alias("rank")).where(F.col("rank") <= terms), "rarest")
    need = rare.groupBy("item").agg(F.count(F.lit(1)).alias("need"))
    index = postings(rows, staged(rare.select("term").distinct(), "rare-terms"))
    lists = index.join(small(rare), "term").withColumn("cell", F.floor(F.col("pos") / within))
    centre = lists.where("rank = 1").select("__id", "__th", "item", F.col("pos").alias("at"), F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    near = centre.join(lists, ["__id", "__th", "item", "cell"]).where(F.abs(F.col("pos") - F.col("at")) <= within)
    gap = near.groupBy("__id", "__th", "item", "at", "rank").agg(F.min_by("pos", F.struct(F.abs(F.col("pos") - F.col("at")), "pos")).alias("pos"))
    whole = gap.groupBy("__id", "__th", "item", "at").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    whole = whole.join(need, "item").where("n = need")
    best = whole.groupBy("__id", "__th", "item").agg(F.min(F.struct(F.expr("last - first").alias("span"), "first", "last")).alias("b"))
    return best.select(F.col("__id").alias(id_col), "item", "b.first", "b.last")
