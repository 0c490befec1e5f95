"""Benchmark decontamination: a prefix-filtered join of item windows with document words."""

from __future__ import annotations

from string import ascii_letters, ascii_lowercase, digits

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wattloom.llm.common import BROADCAST_ROWS, ascii_lower, if_small
from wattloom.session import materialize


def _runs_of(kept: str) -> str:
    """Pattern of runs of ``kept`` and of everything beyond ASCII.

    Each other character is named singly: Java looks those up in one table,
    while ranges are tried one after another, at ten times the cost.
    """
    return "[^" + "".join(f"\\x{i:02X}" for i in range(128) if chr(i) not in kept) + "]+"


#: Words of lower-cased text, and words before A-Z are lower-cased.
WORD, ANY_CASE = _runs_of(digits + ascii_lowercase), _runs_of(digits + ascii_letters)


def _words(text):
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _n_words(text):
    """How many words; lower-casing A-Z does not change that."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(ANY_CASE))


def _shingles(words, size: int):
    """Hashes of the runs of ``size`` words; a shorter text has one, of all its words."""
    def run(i):
        return F.xxhash64(*[F.get(words, i + j) for j in range(size)])
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0))), run)


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows of the items: ``(words, item_ids)``."""
    w = items.select(F.col("item_id").cast("string").alias("item_id"), _words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    w = w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, window))).alias("words"))
    return w.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))


def _search(docs: DataFrame, found: DataFrame, size: int, most: int) -> DataFrame:
    """Occurrences of windows that have ``size`` to ``most`` words.

    Documents are cut into shingles once: those that some window has are
    written with the words around them, as far as a window may reach, and serve
    both to count shingles and to compare words.
    """
    grams = found.select("words", F.posexplode(_shingles(F.col("words"), size)).alias("offset", "gram"))
    spots = docs.select("doc_id", "text_hash", "w", F.posexplode(_shingles(F.col("w"), size)).alias("pos", "gram"))
    before = F.least(F.col("pos"), F.lit(most - size))

    def around(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "text_hash", "pos", "gram", before.alias("before"),
                         F.slice("w", F.col("pos") - before + 1, before + most).alias("near"))
    wanted = grams.select("gram").distinct()
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    spots = materialize(around(spots.join(F.broadcast(wanted), "gram")) if few else around(spots).join(wanted, "gram"))
    counts = spots.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rare = grams.join(counts, "gram", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "offset")).alias("rarest"))
    rare = rare.where("rarest.n > 0").join(found, "words").select(
        "words", "item_ids", "rarest.gram", "rarest.offset", F.size("words").alias("n"))
    rare = if_small(materialize(rare))
    skipped = F.col("before") - F.col("offset")
    fits = (skipped >= 0) & (skipped + F.col("n") <= F.size("near"))
    return spots.join(rare, "gram").where(fits).where(F.slice("near", skipped + 1, F.col("n")) == F.col("words")) \
        .select("doc_id", "text_hash", (F.col("pos") - F.col("offset")).alias("start"), "n", "item_ids")


def occurrences(docs: DataFrame, items: DataFrame, *, window: int = 10, size: int = 3) -> DataFrame:
    """Where windows of benchmark items stand in documents: ``(doc_id, text_hash, start, n, item_ids)``.

    A window is ``window`` consecutive item words, or a shorter item's whole.
    Its shingles (runs of ``size`` words) are ordered by how often documents
    have them.  Containment must be whole, so the one rarest shingle is a
    sufficient prefix: documents are joined on it alone.  A hit must then leave
    room for the window before and behind (positional and length bounds), and
    the words themselves must be equal.  A window with a shingle that no
    document has is not joined at all.  Windows shorter than a shingle go
    through the same search with single words.

    Item words, not documents, are broadcast, and only below a checked number
    of rows.
    """
    found = materialize(windows_of(items, window))
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("w")).where("size(w) > 0")
    hits = _search(docs, found.where(F.size("words") >= size), size, max(window, size))
    short = found.where(F.size("words") < size)
    return hits if short.isEmpty() else hits.union(_search(docs, short, 1, size - 1))


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = 10, size: int = 3) -> DataFrame:
    """What each document shares with benchmark items.

    Words are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased.  Returns a row per row of ``docs``: ``doc_id``, ``n_words``,
    ``n_hit`` (words inside occurrences of windows), ``n_items`` and
    ``items`` (sorted ids with an occurring window) and ``contaminated``.

    Texts that are null or have no words have no hits; items without words
    have no windows.  Items are known by their id as a string, null ids are
    left out of ``items``.  Repeated rows get equal results; rows are told
    apart by doc_id (null counts as a value) and text.  Other columns are not
    read; empty tables give no hits.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    hits = materialize(occurrences(docs, items, window=window, size=size))
    spans = hits.groupBy("doc_id", "text_hash", "start").agg(F.max(F.col("start") + F.col("n")).alias("stop"))
    before = W.partitionBy("doc_id", "text_hash").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    seen = F.coalesce(F.max("stop").over(before), F.lit(0))
    spans = spans.withColumn("fresh", F.greatest(F.col("stop") - F.greatest(seen, F.col("start")), F.lit(0)))
    covered = spans.groupBy("doc_id", "text_hash").agg(F.sum("fresh").alias("n_hit"))
    items_hit = hits.select("doc_id", "text_hash", F.explode("item_ids").alias("item")).distinct() \
        .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = covered.alias("c").join(
        items_hit.alias("i"), F.expr("c.doc_id <=> i.doc_id and c.text_hash = i.text_hash"), "left") \
        .select("c.doc_id", "c.text_hash", "n_hit", "items")
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _n_words(F.col("text")).alias("n_words"))
    return base.alias("d").join(found.alias("f"), F.expr("d.doc_id <=> f.doc_id and d.text_hash = f.text_hash"), "left") \
        .select("d.doc_id", F.col("n_words").cast("long").alias("n_words"),
                F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce(F.array_size("items"), F.lit(0)).cast("long").alias("n_items"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                F.col("n_hit").isNotNull().alias("contaminated"))
