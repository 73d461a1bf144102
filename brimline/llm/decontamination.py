"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is 13 consecutive words of a benchmark item, or all words of a shorter item. Its fingerprint is the smallest hash among
its 8 six-word grams (a shorter window's is the hash of the whole). Documents and items are fingerprinted alike, so a document that
holds a window holds its fingerprint: no shared window is missed.

1. Each document keeps the distinct fingerprints of its windows, far fewer than its words, because neighbours share them.
2. Documents that share a fingerprint with an item are candidates.
3. Hits of candidates are extended: windows whose fingerprint hits are written out and joined with the items' windows
   word for word, so a result rests on equal words and never on a hash.

A row is known by its doc_id and the hash of its text, so repeated doc_ids with other texts keep apart.

Defined results: a null or empty text has no words and no hits; items without words have no window; an item without an id marks words
but is not counted; repeated rows each get their result; long texts are read whole; extra columns are not read by `find`, and
`remove` keeps them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from brimline.sources.writers import materialize

WINDOW, GRAM = 13, 6
#: A document is contaminated if at least one word in SHARE is hit.
SHARE = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ("doc_id", "text_hash")


def words(text: Column) -> Column:
    """Runs of letters and digits, with A-Z in lower case. lower() does the same for texts of ASCII only, and faster."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _ahead(df: DataFrame, name: str, first: str, second: str, by: int, f) -> DataFrame:
    """A new array: f(first[i], second[i + by]); what lies beyond the end is null, and such places are cut off later."""
    return df.withColumn(name, F.zip_with(first, F.slice(second, F.lit(by + 1), F.col("n_words")), f))


def _grams(df: DataFrame, length: int, made: set[int]) -> DataFrame:
    """Adds g{length}, hashes of all runs of that many words, from runs of half the length."""
    if length in made:
        return df
    half = 1 << (length - 1).bit_length() - 1
    df = _grams(_grams(df, half, made), length - half, made)
    made.add(length)
    return _ahead(df, f"g{length}", f"g{half}", f"g{length - half}", half, lambda a, b: F.xxhash64(a, b))


def fingerprints(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds f{length}, the fingerprint of every window of each length, to a table with `words`.

    The smallest of 8 neighbours comes from the smaller of two smallest of four, and so on.
    """
    df = df.withColumn("n_words", F.size("words")).withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    made = {1}
    for length in lengths:
        df = _grams(df, min(length, GRAM) if length == WINDOW else length, made)
        source = f"g{GRAM}" if length == WINDOW else f"g{length}"
        if length == WINDOW:
            reach = 1
            while reach < WINDOW - GRAM + 1:
                by = min(reach, WINDOW - GRAM + 1 - reach)
                df = _ahead(df, f"m{reach + by}", source, source, by, lambda a, b: F.least(a, b))
                source, reach = f"m{reach + by}", reach + by
        df = df.withColumn(f"f{length}", F.slice(source, F.lit(1), F.greatest(F.lit(0), F.col("n_words") - (length - 1))))
    return df


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, length, fingerprint, window) of every window of every item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where("size(words) > 0").withColumn(
        "length", F.least(F.size("words"), F.lit(WINDOW)))
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())
    out = None
    for n in lengths:  # at most 13
        own = fingerprints(items.where(F.col("length") == n), [n]).select(
            "item_id", "length", "words", F.posexplode(f"f{n}").alias("at", "fingerprint")).select(
            "item_id", "length", "fingerprint", _window(F.col("words"), F.col("at"), n).alias("window"))
        out = own if out is None else out.union(own)
    return materialize((out if out is not None else items.select(
        "item_id", "length", F.lit(0).cast("long").alias("fingerprint"), F.lit("").alias("window"))).distinct())


def _window(all_words: Column, at: Column, length: Column | int) -> Column:
    length = F.lit(length) if isinstance(length, int) else length
    return F.array_join(F.slice(all_words, at + 1, length), " ")


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items, spans, contaminated) for each document; spans are (start, end) in words."""
    windows = item_windows(benchmark)
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    prints = fingerprints(docs.select(*KEY, words(F.col("text")).alias("words")), lengths)
    kept = [F.array_distinct(f"f{n}") for n in lengths] or [F.array().cast("array<bigint>")]
    prints = materialize(prints.select(*KEY, "n_words", F.concat(*kept).alias("fingerprints")))

    known = windows.select("fingerprint").distinct()
    keys = prints.select(*KEY, F.explode("fingerprints").alias("fingerprint")).join(
        known, "fingerprint", "left_semi").select(*KEY).distinct()
    found = materialize(_same_key(docs, materialize(keys), "left_semi").distinct().withColumn(
        "words", words(F.col("text"))).select(*KEY, "words"))

    hits = None
    for n in lengths:
        own = fingerprints(found, [n]).select(*KEY, F.posexplode(f"f{n}").alias("at", "fingerprint")).join(
            known, "fingerprint", "left_semi").select(*KEY, F.struct("at", F.lit(n).alias("length")).alias("place"))
        hits = own if hits is None else hits.union(own)
    if hits is None:
        return prints.select(
            *KEY, "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<bigint>").alias("items"),
            F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.lit(False).alias("contaminated"))
    places = hits.groupBy(*KEY).agg(F.collect_list("place").alias("places"))
    written = _same_key(found, places, "inner").select(*KEY, F.transform("places", lambda p: F.struct(
        p["at"].alias("at"), p["length"].alias("length"),
        _window(F.col("words"), p["at"], p["length"]).alias("window"))).alias("places"))
    exact = written.select(*KEY, F.inline("places")).join(windows.drop("fingerprint"), ["length", "window"])
    span = F.struct(F.col("at").alias("start"), (F.col("at") + F.col("length")).alias("end"))
    result = exact.groupBy(*KEY).agg(
        F.array_sort(F.collect_set(span)).alias("spans"), F.collect_set("item_id").alias("items"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", start, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["end"]))).alias("n"),
        F.greatest(a["end"], x["end"]).alias("end")), lambda a: a["n"])
    whole = _same_key(prints.select(*KEY, "n_words"), result.withColumn("n_hit", covered), "left").select(
        *KEY, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast(result.schema["items"].dataType)).alias("items"),
        F.coalesce("spans", F.array().cast(result.schema["spans"].dataType)).alias("spans"))
    return whole.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def _same_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """A join on KEY in which null ids are equal too."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in KEY})
    on = (left["text_hash"] == other["_text_hash"]) & left["doc_id"].eqNullSafe(other["_doc_id"])
    return left.join(other, on, how).drop(*[f"_{k}" for k in KEY])


def digest(found: DataFrame) -> DataFrame:
    """Counts and the digest of the items of `find`, one row for each of its rows."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit",
                        F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    bad = find(docs, benchmark).where("contaminated").select(*KEY).distinct()
    kept = docs.columns
    marked = docs.select(F.struct(*kept).alias("kept"), "doc_id", F.xxhash64("text").alias("text_hash"))
    return _same_key(marked, bad, "left_anti").select("kept.*")
