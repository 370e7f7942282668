"""Benchmark decontamination by winnowed fingerprints, with DataFrame functions only.

A fingerprint is the least hash of ``K``-word runs in each sliding window of ``SPAN`` such runs. Any
shared span of ``K + SPAN - 1`` = 13 words has one whole window in common and so a fingerprint: no such
span is missed. Documents and items are joined on fingerprints; each hit is extended to its whole
window, whose words must be the same, under 128 bits of hash. Positions of items are not joined, so a
text of one word over and over has as many hits as words, and no pairs of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WINDOW, K, SPAN = 13, 8, 6
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 1_000_000    # fingerprints (one long) of a benchmark that is sent to all executors
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_words(text: Column) -> Column:
    """Words of a text already in lower case; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def _fold(text: Column) -> Column:
    """Lower case, the same for a word alone as in its text: only a capital sigma looks at what follows."""
    return F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3")))


def _ahead(column: str, by: int) -> Column:
    return F.slice(F.col(column), F.lit(by + 1), F.greatest(F.size(column) - by, F.lit(0)))


def _with_runs(df: DataFrame) -> DataFrame:
    """Add ``g8``: at every word the hash of the 8 words from there on; runs over the end are junk."""
    df = df.withColumn("g8", F.transform("words", lambda w: F.xxhash64(w)))
    for by in (1, 2, 4):
        df = df.withColumn("g", F.col("g8")).withColumn(
            "g8", F.zip_with("g", _ahead("g", by), lambda a, b: F.xxhash64(a, b))).drop("g")
    return df


def _with_least(df: DataFrame) -> DataFrame:
    """Add ``m6``: at every word the least hash of the 6 runs from there on; ``words`` goes."""
    least = lambda a, b: F.least(a, b)
    df = _with_runs(df).drop("words")
    df = df.withColumn("m2", F.zip_with("g8", _ahead("g8", 1), least)).drop("g8")
    df = df.withColumn("m4", F.zip_with("m2", _ahead("m2", 2), least))
    return df.withColumn("m6", F.zip_with("m4", _ahead("m2", 4), least)).drop("m2", "m4")


def _fingerprints(df: DataFrame) -> DataFrame:
    """Add ``print``, a row for every distinct least hash; ``words`` goes."""
    df = _with_least(df)
    kept = [c for c in df.columns if c != "m6"]
    return df.select(*kept, F.explode(F.array_distinct("m6")).alias("print"))


def _windows(df: DataFrame) -> DataFrame:
    """A row for every whole window: ``at``, its fingerprint ``print``, and ``p``, ``q`` for its words.

    The two are the hashes of its first and its last 8 words as they stand in ``exact``.
    """
    kept = [c for c in df.columns if c not in ("words", "exact")]
    df = _with_least(df.withColumn("n_here", F.size("exact")))
    df = _with_runs(df.withColumnRenamed("exact", "words")).drop("words")
    all_of = F.arrays_zip(F.col("m6").alias("print"), F.col("g8").alias("p"), _ahead("g8", WINDOW - K).alias("q"))
    return (df.select(*kept, "n_here", F.posexplode(all_of).alias("at", "w"))
            .where(F.col("at") + WINDOW <= F.col("n_here")).select(*kept, "at", "w.*"))


def _short_windows(df: DataFrame, sizes: list[int]) -> DataFrame:
    """The same for runs of as many words as a short item has: ``at``, ``size``, ``p`` and ``q``."""
    def runs(n: int) -> Column:
        text = lambda i: F.array_join(F.slice("exact", i, n), " ")
        return F.transform(F.sequence(F.lit(1), F.size("exact") - n + 1), lambda i: F.struct(
            (i - 1).alias("at"), F.lit(n).alias("size"), F.xxhash64(F.lit(n), text(i)).alias("p"),
            F.xxhash64(text(i), F.lit(~n)).alias("q")))
    kept = [c for c in df.columns if c not in ("words", "exact")]
    none = F.array().cast("array<struct<at:int,size:int,p:bigint,q:bigint>>")
    parts = [F.when(F.size("exact") >= n, runs(n)).otherwise(none) for n in sizes]
    return df.select(*kept, F.inline(F.concat(*parts)))


def _short_runs(df: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for every distinct run of as many words as a short item has."""
    runs = [F.transform(F.sequence(F.lit(1), F.size("words") - n + 1),
                        lambda i, n=n: F.xxhash64(F.lit(n), F.array_join(F.slice("words", i, n), " ")))
            for n in sizes]
    guarded = [F.when(F.size("words") >= n, r).otherwise(F.array().cast("array<bigint>"))
               for n, r in zip(sizes, runs)]
    kept = [c for c in df.columns if c != "words"]
    return df.select(*kept, F.explode(F.array_distinct(F.concat(*guarded))).alias("print"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated, ``row_key``.

    Words are runs of digits, letters and non-ASCII characters, A-Z in lower case. A window is 13
    consecutive words of an item, or all words of a shorter one. A document word inside any occurrence
    of a window is hit; ``n_items`` items have occurring windows. Contaminated: n_hit > 0 and
    20 * n_hit >= n_words. Null and empty texts have no words and are clean; items without words have
    no window; an empty benchmark leaves all clean. Items with equal words are compared once. Texts of any length
    are taken whole, in time that grows with their words.
    ``row_key`` is a hash of id and text: equal rows share it and get equal results.
    """
    lower = lambda c: F.translate(c, _UPPER, _LOWER)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(id_col, text_col).alias("row_key"))
    items = benchmark.select(F.col(item_col).alias("item_id"),
                             split_words(lower(F.col(item_text_col))).alias("exact"))
    items = items.where(F.size("exact") > 0).withColumn("item", F.xxhash64("exact"))
    texts = items.groupBy("item", "exact").agg(F.count("*").alias("n")).select(
        "item", "exact", F.transform("exact", lambda w: _fold(w)).alias("words"))
    long_items = texts.where(F.size("words") >= WINDOW)
    short = texts.where(F.size("words") < WINDOW)
    sizes = [r["n"] for r in short.select(F.size("words").alias("n")).distinct().collect()]  # < 13

    def small(df: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(df) if rows <= BROADCAST_ROWS else df

    n_words_in = texts.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    words = docs.withColumn("words", split_words(_fold(F.col("text"))))
    prints = _fingerprints(long_items.select("words")).distinct()
    met = (_fingerprints(words.select("row_key", "words"))
           .join(small(prints, n_words_in), "print").select("row_key"))
    if sizes:
        ends = _short_runs(short.select("words"), sizes).distinct()
        met = met.unionByName(_short_runs(words.select("row_key", "words"), sizes)
                              .join(small(ends, n_words_in), "print").select("row_key"))
    suspects = (docs.join(met.distinct(), "row_key", "left_semi").dropDuplicates(["row_key"])
                .select("row_key", split_words(_fold(F.col("text"))).alias("words"),
                        split_words(lower(F.col("text"))).alias("exact")))

    # Windows of suspects that an item has too, by fingerprint and then by their words.
    of_items = _windows(long_items.select("item", "words", "exact")).select("item", "print", "p", "q").distinct()
    hits = (_windows(suspects).join(small(of_items, n_words_in), ["print", "p", "q"])
            .select("row_key", "item", "at", F.lit(WINDOW).alias("size")))
    if sizes:
        own = _short_windows(short.select("item", "exact", F.size("exact").alias("own")), sizes)
        own = own.where("size = own").select("item", "size", "p", "q").distinct()
        hits = hits.unionByName(_short_windows(suspects.select("row_key", "exact"), sizes)
                                .join(small(own, n_words_in), ["size", "p", "q"]).select("row_key", "item", "at", "size"))
    begins = hits.groupBy("row_key", "at").agg(F.max("size").alias("size"))
    before = Window.partitionBy("row_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.max(F.col("at") + F.col("size")).over(before), F.lit(0))
    fresh = F.greatest(F.col("at") + F.col("size") - F.greatest("at", upto), F.lit(0))
    hit_words = begins.select("row_key", fresh.alias("fresh")).groupBy("row_key").agg(F.sum("fresh").alias("n_hit"))
    names = (hits.select("row_key", "item").distinct()
             .join(small(items.select("item", "item_id"), n_words_in), "item")
             .groupBy("row_key").agg(
                 F.count("item_id").alias("n_items"),
                 F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("names")))
    found = hit_words.join(names, "row_key")
    return (words.select("doc_id", "row_key", F.size("words").cast("long").alias("n_words"))
            .join(found, "row_key", "left")
            .select(F.col("doc_id").alias(id_col), "n_words",
                    F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("names", ","), F.lit("")), 256)
                    .alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0)
                    .__and__(20 * F.coalesce("n_hit", F.lit(0)) >= F.col("n_words"))
                    .alias("contaminated"), "row_key"))
