"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window of 13 item words occurs in a document only if its rarest word does, so that one word is
the window's necessary prefix (containment asks for all 13 words). Words of the benchmark are
ordered by their frequency in the corpus; document words meet the prefix words in a hash join;
length and position bounds discard candidates that would overrun the document; the survivors are
verified by comparing the whole window. Document words are exploded in place and joined in the
same stage: what is shuffled is one row per document and the verified hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators._plan import MAX_BROADCAST_BYTES, measured_bytes
from ._common import cut, lower_ascii, with_text_key

WINDOW = 13
# Fixed value: separators; words are the runs of all other characters of the lowered text.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Stands for the end of a document; NUL is a separator, so no word equals it.
END = "\x00"


def words(text: Column) -> Column:
    """Words of a text, an empty array for NULL."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), SEPARATORS), ""),
                      F.array().cast("array<string>"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """(item_id, w): every window of every item as an array of words, distinct."""
    tokens = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("t"))
    width = F.least(F.size("t"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("t") - width + 1)
    return (tokens.where(F.size("t") > 0).select("item_id", "t", F.explode(starts).alias("s"))
            .select("item_id", F.expr(f"slice(t, s, least(size(t), {window}))").alias("w"))
            .distinct())


def _fit(small: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast if the measured size is within ``limit`` bytes."""
    return F.broadcast(small) if measured_bytes(small) <= limit else small


def prefixes(windows: DataFrame, tokens: DataFrame, limit: int) -> DataFrame:
    """(word, before, width, body): per distinct window its rarest corpus word, how many window
    words stand before it, and the window as text. Ties go to the smaller word, then leftwards."""
    distinct = windows.select("w", F.concat_ws(" ", "w").alias("body")).distinct()
    parts = distinct.select("body", F.size("w").alias("width"),
                            F.posexplode("w").alias("before", "word"))
    vocabulary = cut(parts.select("word").distinct())
    seen = (tokens.select(F.explode("t").alias("word"))
            .join(_fit(vocabulary, limit), "word").groupBy("word").count())
    ranked = parts.join(seen, "word", "left").select(
        "body", "width", F.struct(F.coalesce("count", F.lit(0)).alias("n"), "word",
                                  "before").alias("rank"))
    return (ranked.groupBy("body", "width").agg(F.min("rank").alias("rank"))
            .where("rank.n > 0")
            .select(F.col("rank.word").alias("word"), F.col("rank.before").alias("before"),
                    "width", "body"))


def _in_place(tokens: DataFrame, needles: DataFrame) -> DataFrame:
    """Explode, look up and verify within the scan stage; the end marker keeps every row."""
    mark = needles.sparkSession.createDataFrame(
        [(END, 0, 0, None)], "word string, before int, width int, body string")
    spread = tokens.select("_id", "_key", "t", F.posexplode(
        F.concat("t", F.array(F.lit(END)))).alias("pos", "word"))
    begin = F.col("pos") - F.col("before")
    fits = (begin >= 0) & (begin + F.col("width") <= F.size("t"))
    same = F.expr("concat_ws(' ', slice(t, pos - before + 1, width))") == F.col("body")
    ends = F.col("body").isNull()
    return (spread.join(F.broadcast(needles.unionByName(mark)), "word")
            .where(ends | (fits & same))
            .select("_id", "_key", "body", begin.alias("begin"), "width",
                    F.when(ends, F.size("t")).alias("n")))


def _by_shuffle(tokens: DataFrame, needles: DataFrame) -> DataFrame:
    """The same rows for prefix words too many to broadcast: candidates travel without the text
    and are verified against their document afterwards."""
    spread = tokens.select("_id", "_key", F.size("t").alias("size"),
                           F.posexplode("t").alias("pos", "word"))
    begin = F.col("pos") - F.col("before")
    found = (spread.join(needles, "word")
             .where((begin >= 0) & (begin + F.col("width") <= F.col("size")))
             .select("_key", "body", begin.alias("begin"), "width").distinct())
    hits = (tokens.select("_id", "_key", "t").join(found, "_key")
            .where(F.expr("concat_ws(' ', slice(t, begin + 1, width))") == F.col("body"))
            .select("_id", "_key", "body", "begin", "width", F.lit(None).cast("int").alias("n")))
    ends = tokens.select("_id", "_key", F.lit(None).cast("string").alias("body"),
                         F.lit(0).alias("begin"), F.lit(0).alias("width"),
                         F.size("t").alias("n"))
    return hits.unionByName(ends)


def covered(spans: Column) -> Column:
    """Words under a set of (begin, width) spans."""
    step = F.aggregate(
        F.sort_array(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["begin"] + x["width"]
                                 - F.greatest(a["end"], x["begin"]))).alias("n"),
            F.greatest(a["end"], x["begin"] + x["width"]).alias("end")))
    return step["n"]


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, _key (xxhash64 of the text), contaminated:
    one row per row of ``docs``.

    An item shorter than ``window`` words is one window; items without words are ignored. A
    document is contaminated if it has hit words and they are 5 % of its words or more. NULL and
    empty texts have no words and are clean; an item with a NULL id marks words but is not
    counted; repeated items count once, repeated documents are repeated in the result; an empty
    benchmark leaves every document clean; other columns are not read.
    """
    tokens = with_text_key(docs, id_col, text_col).select(
        "_id", "_key", words(F.col("_text")).alias("t"))
    windows = cut(item_windows(items, item_id_col, item_text_col, window))
    needles = cut(prefixes(windows, tokens, max_broadcast_bytes))
    small = measured_bytes(needles) <= max_broadcast_bytes
    hits = (_in_place if small else _by_shuffle)(tokens, needles)
    owners = cut(windows.select(F.concat_ws(" ", "w").alias("body"),
                                F.col("item_id").cast("string").alias("item")).distinct())
    span = F.when(F.col("body").isNotNull(), F.struct("begin", "width"))
    folded = (hits.join(_fit(owners, max_broadcast_bytes), "body", "left")
              .groupBy("_id", "_key")
              .agg(F.collect_set(span).alias("spans"), F.collect_set("item").alias("items"),
                   F.max("n").alias("n_words"), F.count("n").alias("rows")))
    n_words, n_hit = F.col("n_words").cast("long"), covered(F.col("spans")).cast("long")
    return (folded.select(
        F.col("_id").alias("doc_id"), n_words.alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"), "_key",
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_copy"))
        .drop("_copy")
        .withColumn("contaminated", (F.col("n_hit") > 0)
                    & (20 * F.col("n_hit") >= F.col("n_words"))))
