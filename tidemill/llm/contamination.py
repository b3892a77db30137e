"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions only.

Every run of ten item words is a window, a set of placed words of which a document must hold all. The
words of a window are ordered by rarity in the documents; as all are needed, its prefix is the rarest
one. Documents meet windows at that word only; positions and lengths bound where the window can
lie; candidates are then compared word by word, at once where the windows fit into every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import ALNUM_WORD, lowered
from tidemill.session import materialise

WINDOW = 10
# Windows and their words are broadcast only if counted and at most so many.
FEW_WINDOWS = 200_000
# Digests of texts with hits are broadcast likewise.
FEW_TEXTS = 200_000


def word_list(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lowered(text), F.lit(ALNUM_WORD), F.lit(0)), F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``window, words``) and the items that hold them (``window, item_id``). An item of
    fewer words is one window; one without words has none."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_list(F.col("text")).alias("words")).where(F.size("words") > 0)
    placed = items.select(
        "item_id", "words", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - window + 1))).alias("at")
    ).select("item_id", F.expr(f"slice(words, at, {window})").alias("words"))
    placed = placed.select("item_id", F.array_join("words", " ").alias("window"), "words")
    distinct = placed.select("window", "words").dropDuplicates(["window"])
    return distinct, placed.select("window", "item_id").distinct()


def _hits_in_place(texts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``row, doc_id, digest, n_words, start, n, window``: what each text holds, compared where it is read, and its end.

    Texts are cut into words once and not moved. The words stay beside their places, as a reference, for the
    comparison; an empty window after the last word of every text stands for the text itself.
    """
    end = prefixes.sparkSession.createDataFrame([("", 0, 0, "")], "window STRING, n INT, offset INT, word STRING")
    placed = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "digest", word_list(F.col("text")).alias("words"))
    placed = placed.select("*", F.size("words").cast("bigint").alias("n_words"), F.array_append("words", F.lit("")).alias("with_end"))
    # outer: no filter on the number of words is inferred, for which they would be made a second time
    placed = placed.select("row", "doc_id", "digest", "n_words", "words", F.posexplode_outer("with_end").alias("at", "word"))
    start = F.col("at") - F.col("offset")
    met = placed.join(F.broadcast(prefixes.unionByName(end)), "word").where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    met = met.where(F.array_join(F.slice("words", start + 1, F.col("n")), " ") == F.col("window"))
    return met.select("row", "doc_id", "digest", "n_words", start.alias("start"), "n", "window")


def _hits_after_shuffle(texts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The same for windows too many to be sent to every task: words meet them in a shuffle, and texts their candidates."""
    # words and their number are made below the generator: beside it they would be made for each word
    placed = texts.select("digest", word_list(F.col("text")).alias("words")).select("digest", "words", F.size("words").alias("n_words"))
    placed = placed.select("digest", "n_words", F.posexplode_outer("words").alias("at", "word"))
    start = F.col("at") - F.col("offset")
    candidates = (
        placed.join(prefixes, "word").where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        .select("digest", F.struct(start.alias("start"), "n", "window").alias("candidate"))
        .groupBy("digest").agg(F.collect_set("candidate").alias("candidates"))
    )
    rows = texts.join(candidates, "digest", "left").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "digest", "candidates", word_list(F.col("text")).alias("words")
    )
    same = F.expr("filter(candidates, c -> array_join(slice(words, c.start + 1, c.n), ' ') = c.window)")
    end = F.struct(F.size("words").alias("start"), F.lit(0).alias("n"), F.lit("").alias("window"))
    hits = F.array_append(F.coalesce(same, F.array().cast("array<struct<start:int,n:int,window:string>>")), end)
    rows = rows.select("row", "doc_id", "digest", F.size("words").cast("bigint").alias("n_words"), F.explode_outer(hits).alias("hit"))
    return rows.select("row", "doc_id", "digest", "n_words", "hit.start", "hit.n", "hit.window")


def hits_of_texts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, bool]:
    """For each row of ``docs`` a number ``row`` of its own, its ``doc_id``, ``digest`` of the text, ``n_words``, ``n_hit`` and
    the ``windows`` it holds; the items of each window; and whether the windows are few."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "digest", F.md5("text")
    )
    windows, holders = (materialise(x, kind) for x, kind in zip(item_windows(benchmark, window), ("item-windows", "window-items")))
    few = windows.count() <= FEW_WINDOWS
    small = F.broadcast if few else lambda x: x

    # rarity: how often the documents have each item word; a window with a word they lack cannot occur
    item_words = windows.select(F.explode("words").alias("word")).distinct()
    rarity = texts.select(F.explode_outer(word_list(F.col("text"))).alias("word")).join(small(item_words), "word").groupBy("word").count()
    rarity = materialise(rarity, "item-word-counts")
    counted = (
        windows.select("window", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
        .join(small(rarity), "word", "left")
        .groupBy("window", "n").agg(
            F.min(F.struct("count", "offset", "word")).alias("prefix"), F.count("count").alias("known"),
        ).where("known = n")
    )
    prefixes = counted.select("window", "n", F.col("prefix.offset").alias("offset"), F.col("prefix.word").alias("word"))

    hits = _hits_in_place(texts, prefixes) if few else _hits_after_shuffle(texts, prefixes)
    of_item = F.when(F.col("n") > 0, F.struct("start", "n", "window"))
    rows = hits.groupBy("row", "doc_id", "digest", "n_words").agg(F.collect_list(of_item).alias("hits"))
    covered = F.expr(
        "aggregate(array_sort(transform(hits, h -> struct(h.start AS s, h.start + h.n AS e))), named_struct('n', 0L, 'end', 0),"
        " (a, x) -> named_struct('n', a.n + greatest(0, x.e - greatest(a.end, x.s)), 'end', greatest(a.end, x.e)), a -> a.n)"
    )
    rows = materialise(
        rows.select("row", "doc_id", "digest", "n_words", covered.alias("n_hit"), F.array_distinct(F.col("hits.window")).alias("windows")), "window-hits"
    )
    return rows, holders, few


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs``, all columns, whose text holds no window of any item; null texts hold none."""
    hit = hits_of_texts(docs, benchmark, window)[0].where("n_hit > 0").select(F.col("digest").alias("_tidemill_digest")).distinct()
    hit = materialise(hit, "hit-texts")
    hit = F.broadcast(hit) if hit.count() <= FEW_TEXTS else hit
    return docs.join(hit, F.md5(F.coalesce("text", F.lit(""))) == F.col("_tidemill_digest"), "left_anti")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row of ``docs``.

    A word is hit if it lies inside any occurrence of an item's window. Null and empty texts have no words
    and are clean; null and repeated ids give a row each. Repeated item ids count once; an item without an id
    marks words but is not listed. Without items nothing is hit; an empty table gives no rows.
    """
    rows, holders, few = hits_of_texts(docs, benchmark, window)
    listed = (
        rows.where("n_hit > 0").select("row", F.explode("windows").alias("window"))
        .join(F.broadcast(holders) if few else holders, "window").where(F.col("item_id").isNotNull())
        .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(listed, "row", "left").select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
