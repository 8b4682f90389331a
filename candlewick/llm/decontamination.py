"""Benchmark decontamination by winnowing, in DataFrame functions only.

A benchmark window is 13 consecutive words of an item (a shorter item is one
window). Documents and items are fingerprinted with 7-word hashes of which the
smallest in every run of 7 is kept, so every shared span of 13 words keeps a
fingerprint on both sides. Document fingerprints are joined to the items'
fingerprints, and each hit is extended: every 13-word window that holds it is
looked up among the items' windows, so a hit is exactly an occurring window.
Items shorter than a window lie below that guarantee; for each of their lengths
(at most 12) all document runs of that length are looked up instead.

Hashes are 64 bits. The texts are read and split once: one pass gives the number
of words, the fingerprints and the short runs, and keeps those that the benchmark
has too. Only the table of the benchmark's fingerprints is broadcast, and only
after its rows have been counted (``BROADCAST_ROWS``); a larger one is shuffle-joined.
Windows found in a document meet in one row per map task before the shuffle.

Defined results: null text has no words; null item text gives no window; the
windows of an item with a null item_id count as hits, but no id is listed; null ``doc_id`` stays null; repeated documents are judged each,
repeated items count once per item_id; with an empty benchmark nothing is hit;
``clean_documents`` returns the input's columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored

# Fixed values of the contract: what separates words, and a window's words.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
GRAM = 7                     # words of a fingerprint
RUN = WINDOW - GRAM + 1      # fingerprints of a window; the smallest is kept
#: A benchmark table of more rows is not broadcast (two numbers a row: some 20 MB in memory).
BROADCAST_ROWS = 500_000


def _split(text: str) -> str:
    """SQL for the words of a lower-cased text column: leading and trailing empty strings cut off."""
    parts = f"split({text}, r'{SEPARATOR}')"
    return (f"transform(array({parts}), s -> slice(s, if(s[0] = '', 2, 1), greatest(0, "
            f"size(s) - if(s[0] = '', 1, 0) - if(s[size(s) - 1] = '', 1, 0))))[0]")


def _words(rows: DataFrame) -> DataFrame:
    """``rows`` (with text) with words and n."""
    return (rows.withColumn("lowered", F.translate("text", UPPER, LOWER))
            .withColumn("words", F.expr(_split("lowered"))).drop("text", "lowered")
            .withColumn("n", F.size("words")))


def _grams(rows: DataFrame) -> DataFrame:
    """With ``grams``: the hash of each run of GRAM words."""
    items = ", ".join(f"words[i + {j}]" for j in range(GRAM))
    return rows.withColumn("grams", F.expr(
        f"if(n < {WINDOW}, array(), transform(sequence(0, n - {GRAM}), i -> xxhash64({items})))"))


def _winnowed(rows: DataFrame) -> DataFrame:
    """With ``kept``: places of the kept fingerprints. Hash and place share a long (32 bits each),
    so the smallest value of a run is the smallest hash, the leftmost on ties."""
    ranked = rows.withColumn("ranked", F.expr(
        "transform(grams, (h, i) -> (h & shiftleft(-1L, 32)) | i)"))
    run = ", ".join(f"ranked[i + {j}]" for j in range(RUN))
    return ranked.withColumn("kept", F.expr(
        f"if(size(grams) < {RUN}, array(), transform(array_distinct(transform("
        f"sequence(0, size(grams) - {RUN}), i -> least({run}))), x -> cast(x & 4294967295L as int)))")).drop("ranked")


def _window_hash(grams: str, i: str) -> str:
    return f"xxhash64({grams}[{i}], {grams}[{i} + {WINDOW - GRAM}])"


def _run_hash(length: int, i: str) -> str:
    return "xxhash64(" + ", ".join(f"words[{i} + {j}]" for j in range(length)) + ")"


def _runs(rows: DataFrame, length: int, *keep: str) -> DataFrame:
    """(keep.., hash) of every run of ``length`` words."""
    return (rows.where(F.col("n") >= length)
            .select(*keep, F.explode(F.expr(f"transform(sequence(0, n - {length}), "
                                            f"i -> {_run_hash(length, 'i')})")).alias("hash")))


def _bounded(df: DataFrame) -> DataFrame:
    """A stored benchmark table of two numbers a row, marked for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a hash of the text: equal rows share a key, others do not meet."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_key"))


def _candidates(words: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """(keep.., len, hash, start, near): one pass over the words. Of each document: a row with len 0 and
    its number of words as ``start``; each kept fingerprint (len 13) with the grams around it, which hold
    the windows that contain it; and every run of the short items' lengths."""
    row = "cast({} as int) as len, {} as hash, cast({} as int) as start, {} as near"
    none = "cast(null as array<bigint>)"
    kept = row.format(WINDOW, "grams[p]", f"greatest(p - {RUN - 1}, 0)",
                      f"slice(grams, greatest(p - {RUN - 1}, 0) + 1, least(p, {RUN - 1}) + {RUN})")
    parts = [f"array(struct({row.format(0, '0L', 'n', none)}))", f"transform(kept, p -> struct({kept}))"]
    for n in lengths:
        run = row.format(n, _run_hash(n, "i"), "i", none)
        parts.append(f"if(n < {n}, array(), transform(sequence(0, n - {n}), i -> struct({run})))")
    return _winnowed(_grams(words)).select(*keep, F.explode(F.expr(f"concat({', '.join(parts)})")).alias("c")) \
        .select(*keep, "c.*")


def _found(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, n_words of every row; doc_id, text_key, start, words, items of every occurring
    window). The texts are read once: what that pass keeps is stored."""
    items = _winnowed(_grams(_words(benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")))))
    long_items, short = items.where(F.col("n") >= WINDOW), items.where((F.col("n") < WINDOW) & (F.col("n") > 0))
    lengths = sorted(r["n"] for r in short.select("n").distinct().collect())  # at most 12
    grams = long_items.select(F.lit(WINDOW).alias("len"), F.explode(F.expr("transform(kept, p -> grams[p])")).alias("hash"))
    windows = long_items.select("item", F.lit(WINDOW).alias("len"), F.explode(F.expr(
        f"transform(sequence(0, n - {WINDOW}), i -> {_window_hash('grams', 'i')})")).alias("hash"))
    for n in lengths:
        runs = _runs(short.where(F.col("n") == n), n, "item").select("item", F.lit(n).alias("len"), "hash")
        windows = windows.unionByName(runs)
        grams = grams.unionByName(runs.drop("item"))
    grams = grams.unionByName(grams.sparkSession.range(1).select(F.lit(0).alias("len"), F.lit(0).cast("long").alias("hash")))
    marks = stored(grams.distinct(), "bench-marks")
    windows = stored(windows.groupBy("len", "hash").agg(F.array_sort(F.collect_set("item")).alias("items")),
                     "bench-windows")
    key = ("doc_id", "text_key")
    found = stored(_candidates(_words(docs), lengths, *key).join(_bounded(marks), ["len", "hash"]), "bench-hits")
    counted = found.where("len = 0").select(*key, F.col("start").cast("long").alias("n_words"))
    extended = (found.where(f"len = {WINDOW}")
                .select(*key, "start", F.posexplode(F.expr(
                    f"transform(sequence(0, size(near) - {RUN}), i -> {_window_hash('near', 'i')})")).alias("at", "hash"))
                .select(*key, F.lit(WINDOW).alias("len"), "hash", (F.col("start") + F.col("at")).alias("start")))
    runs = found.where(f"len BETWEEN 1 AND {WINDOW - 1}").select(*key, "len", "hash", "start")
    hits = extended.unionByName(runs).join(windows, ["len", "hash"])
    return counted, hits.select(*key, "start", F.col("len").alias("words"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_words, n_hit (words inside any occurring window), spans (their start and
    length in words), items (sorted ids), contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    keyed = _keyed(docs, id_col, text_col)
    counted, hits = _found(keyed, benchmark, item_col, item_text_col)
    per_doc = (hits.groupBy("doc_id", "text_key")
               .agg(F.collect_set(F.struct("start", "words")).alias("spans"), F.collect_set("items").alias("lists"))
               .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"),
                       F.array_sort("spans").alias("spans"),
                       F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"),
                       F.expr("cast(size(array_distinct(flatten(transform(spans, "
                              "s -> sequence(s.start, s.start + s.words - 1))))) as long)").alias("n_hit")))
    same = counted["doc_id"].eqNullSafe(per_doc["hit_id"]) & (counted["text_key"] == per_doc["hit_key"])
    none = F.lit(0).cast("long")
    return (counted.join(per_doc, same, "left")
            .select("doc_id", "text_key", "n_words", F.coalesce("n_hit", none).alias("n_hit"), "spans",
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))


def clean_documents(docs: DataFrame, benchmark: DataFrame, share: int = 20, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with the input's columns."""
    bad = (contamination(docs, benchmark, share, id_col, text_col, item_col, item_text_col)
           .where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    same = rows["doc_id"].eqNullSafe(bad["bad_id"]) & (rows["text_key"] == bad["bad_key"])
    return rows.join(bad, same, "left_anti").select("row.*")
