"""Benchmark decontamination: a prefix-filtered set join on word shingles, all in Spark functions.

Every item is cut into windows of ``window`` words (one window if it has fewer). For a window to occur
in a text, all its shingles must; so it is enough to look for one, the prefix of length 1 that
containment needs: the first in an order of shingles. Text and window meet on that shingle; its place in
the window bounds where the window can begin and end in the text, and the words there are compared.

One pass makes the shingles of the texts. Up to ``broadcast_rows`` shingles of windows are broadcast to it:
it leaves the places that hold one with the words around them, so that no text is read again. These are
counted, and the order is by rarity, then by hash. Beyond that a
count would have to shuffle every place, so the order is by hash alone: of a text just the places go
through a shuffle whose shingle comes first in some window around it (two in nine), as (text, place,
key), whatever the text's length; texts with a window's place are read again.

Texts are known by two 64-bit hashes, so the work for a text that is there many times is done once.

Defined cases: null texts and texts without words are clean, with zero words; null item texts have no
windows; items with equal texts are all reported; repeated document rows are reported each; other
columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Staging, ascii_lower, broadcast_within, staged, text_keys

#: What is between words, of text with A-Z in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
KEYS = ["t1", "t2"]


def with_item_words(df: DataFrame, name: str) -> DataFrame:
    """df with its column text replaced by the array name of its words."""
    df = df.withColumn("_split", F.split(ascii_lower(F.coalesce("text", F.lit(""))), BETWEEN))
    w = F.col("_split")
    # what stands between words may come first and last, with an empty string outside
    first, last = (F.get(w, F.lit(0)) == "").cast("int"), (F.element_at(w, -1) == "").cast("int")
    return df.withColumn(name, F.slice(w, first + 1, F.greatest(F.size(w) - first - last, F.lit(0)))).drop("_split", "text")


def _shingle(ws: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(ws, at + k) for k in range(size)])


def benchmark_windows(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(win array of words, items array of item_id as text): the distinct windows."""
    items = with_item_words(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text"), "w").where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    wins = items.withColumn("s", F.explode(starts)).select("item_id", F.slice("w", F.col("s") + 1, window).alias("win"))
    return wins.groupBy("win").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _window_shingles(wins: DataFrame) -> DataFrame:
    """(win, items, off, key): the shingles of a window, of as many words as it has if these are fewer."""
    size = F.least(F.size("win"), F.lit(SHINGLE))
    places = wins.withColumn("size", size).withColumn("off", F.explode(F.sequence(F.lit(0), F.size("win") - F.col("size"))))
    key = reduce(lambda a, n: a.when(F.col("size") == n, _shingle(F.col("win"), F.col("off"), n)), range(1, SHINGLE + 1), F.when(F.lit(False), F.lit(0).cast("long")))
    return places.select("win", "items", "off", key.alias("key"))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, text) of each row; null texts are empty."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.withColumns(dict(zip(KEYS, text_keys(F.col("text")))))


def _shingles_at(ws: Column, at: Column, sizes: list[int]) -> list[Column]:
    return [F.when(at + n <= F.size(ws), _shingle(ws, at, n)) for n in sizes]


def _places_of(docs: DataFrame, keys: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(doc_id, t1, t2, n_words, head, at, key, left, near) of the places whose shingle is one of keys, and one row with head for each text. near are up to window words before, of which there are left, and from the place on."""
    rows = with_item_words(_keyed(docs), "ws").select("doc_id", *KEYS, "ws", F.posexplode_outer("ws").alias("at", "_w"))
    head = F.coalesce(F.col("at"), F.lit(0)) == 0
    found = _shingles_at(F.col("ws"), F.col("at"), sizes)
    if len(found) > 1:
        rows = rows.select("doc_id", *KEYS, "ws", "at", F.posexplode(F.array(*found)).alias("_size", "key"))
        head = head & (F.col("_size") == 0)
    else:
        rows = rows.withColumn("key", found[0])
    hit = rows.join(keys.withColumn("_hit", F.lit(True)), "key", "left")
    left = F.least("at", F.lit(window))
    near = F.slice("ws", F.col("at") - left + 1, left + window)
    return hit.where(F.col("_hit") | head).select("doc_id", *KEYS, F.size("ws").cast("long").alias("n_words"), head.alias("head"), "at", F.when(F.col("_hit"), F.col("key")).alias("key"), F.when(F.col("_hit"), left).alias("left"), F.when(F.col("_hit"), near).alias("near"))


def _heads(docs: DataFrame) -> DataFrame:
    return with_item_words(_keyed(docs), "ws").select("doc_id", *KEYS, F.size("ws").cast("long").alias("n_words"))


def _least_places(docs: DataFrame, window: int) -> DataFrame:
    """(t1, t2, n_words, at, key) of all places whose shingle has the least hash in a window around it."""
    width = window - SHINGLE + 1
    rows = with_item_words(_keyed(docs), "ws").select(*KEYS, F.size("ws").cast("long").alias("n_words"), "ws", F.posexplode_outer("ws").alias("at", "_w"))
    rows = rows.select(*KEYS, "n_words", "at", *[F.when(F.col("at") + k + SHINGLE <= F.col("n_words"), _shingle(F.col("ws"), F.col("at") + k, SHINGLE)).alias(f"_h{k}") for k in range(width)])
    # the least of the window that begins here, the first of equal ones
    own = [F.col(f"_h{k}") for k in range(width)]
    rows = rows.where(own[-1].isNotNull()).withColumn("key", F.least(*own))
    place = reduce(lambda a, k: a.when(F.col("key") == own[k], F.col("at") + k), range(1, width), F.when(F.col("key") == own[0], F.col("at"))) if width > 1 else F.col("at")
    # neighbouring windows mostly agree: each place once
    return rows.select(*KEYS, "n_words", place.alias("at"), "key").distinct()


def _candidates(places: DataFrame, prefix: DataFrame) -> DataFrame:
    """places with prefix's windows, of which start says where one would stand in the text, within its bounds."""
    out = places.join(prefix, "key").withColumn("start", F.col("at") - F.col("off"))
    return out.where((F.col("start") >= 0) & (F.col("start") + F.size("win") <= F.col("n_words")))


def _same_words(found: DataFrame) -> DataFrame:
    """(t1, t2, spans, items) of the texts whose words near a place are a window's."""
    begin = F.greatest(F.col("left") - F.col("off"), F.lit(0))
    same = found.where(F.slice("near", begin + 1, F.size("win")) == F.col("win"))
    per = same.groupBy(*KEYS).agg(F.collect_set(F.struct("start", (F.col("start") + F.size("win")).alias("stop"))).alias("spans"), F.collect_set("items").alias("items"))
    return per.select(*KEYS, F.array_sort("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def _verified(docs: DataFrame, found: DataFrame, broadcast_rows: int) -> DataFrame:
    """(t1, t2, spans, items) of the texts that hold one of found: the words are compared."""
    per = found.groupBy(*KEYS).agg(F.collect_set(F.struct("start", "win", "items")).alias("_found"))
    wanted = broadcast_within(found.select(*KEYS).distinct(), found.count(), broadcast_rows)
    texts = _keyed(docs).join(wanted, KEYS, "left_semi").dropDuplicates(KEYS).join(per, KEYS)
    # the words as a row of their own, as a condition on them would else be worked out again from the text
    texts = with_item_words(texts, "ws").select(*KEYS, "_found", F.explode_outer(F.array("ws")).alias("ws"))
    ws = F.col("ws")
    same = F.filter("_found", lambda c: (c["start"] + F.size(c["win"]) <= F.size(ws)) & (F.slice(ws, F.greatest(c["start"], F.lit(0)) + 1, F.size(c["win"])) == c["win"]))
    texts = texts.select(*KEYS, same.alias("_same")).where(F.size("_same") > 0)
    spans = F.array_sort(F.array_distinct(F.transform("_same", lambda c: F.struct(c["start"].alias("start"), (c["start"] + F.size(c["win"])).alias("stop")))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("_same", lambda c: c["items"]))))
    return texts.select(*KEYS, spans.alias("spans"), items.alias("items"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, stage: Staging, window: int = 10, broadcast_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(doc_id, t1, t2, n_words) of each row, and (t1, t2, spans, items) of the texts that hold a window of the benchmark."""
    wins = stage(benchmark_windows(benchmark, window), "windows")
    shingles = stage(_window_shingles(wins), "window-shingles")
    sizes = sorted(r[0] for r in wins.select(F.least(F.size("win"), F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]  # at most SHINGLE sizes
    n_shingles = shingles.count()
    if n_shingles <= broadcast_rows:
        places = stage(_places_of(docs, F.broadcast(shingles.select("key").distinct()), sizes, window), "places")
        heads = places.where("head").select("doc_id", *KEYS, "n_words")
        held = places.where("key is not null")
        rarity = held.groupBy("key").agg(F.count("*").alias("df"))
        # a shingle that no text holds rules its window out altogether
        ranked = shingles.join(rarity, "key", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("win").orderBy("df", "key", "off")))
        found = _candidates(held, F.broadcast(ranked.where("rank = 1 and df > 0").select("key", "off", "win", "items")))
        texts = _same_words(found)
    else:
        heads = stage(_heads(docs), "heads")
        ranked = shingles.withColumn("rank", F.row_number().over(W.partitionBy("win").orderBy("key", "off"))).where("rank = 1")
        prefix = stage(ranked.select("key", "off", "win", "items"), "prefix")
        found = _candidates(_least_places(docs, window), prefix.where(F.size("win") == window)).select(*KEYS, "start", "win", "items")
        # a window of fewer words has no place of its own among these; they come in blocks, one shingle each
        short = prefix.where(F.size("win") < window)
        blocks = -(-short.count() // max(broadcast_rows, 1))
        for b in range(blocks):
            some = F.broadcast(short.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b))
            places = _places_of(docs, F.broadcast(some.select("key").distinct()), sizes, window).where("key is not null")
            found = found.union(_candidates(places, some).select(*KEYS, "start", "win", "items"))
        texts = _verified(docs, stage(found.distinct(), "candidates"), broadcast_rows)
    return heads, texts


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, broadcast_rows: int = 200_000) -> DataFrame:
    """For each text: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit spans."""
    with Staging(docs.sparkSession) as stage:
        heads, texts = contaminated_texts(docs, benchmark, stage, window, broadcast_rows)
        none = F.array().cast("array<struct<start:int,stop:int>>"), F.array().cast("array<string>")
        per = heads.join(texts, KEYS, "left").select("doc_id", "n_words", F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items"))
        per = staged(per, "decontaminated")
    reach = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    hit = F.aggregate("spans", reach, lambda a, s: F.struct((a.n + F.greatest(s.stop - F.greatest(s.start, a.end), F.lit(0))).alias("n"), F.greatest(a.end, s.stop).alias("end")), lambda a: a.n)
    return per.withColumn("n_hit", hit.cast("long")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans",
    )
