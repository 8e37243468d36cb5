"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A short item inside a long document has almost no Jaccard similarity with the document, so signatures of
whole documents cannot find it. Items are therefore partitioned by size into classes of powers of two, and
a document is seen, for each class, as overlapping windows of 1.5 times the class's largest size: every run
of that size lies in one of them. Item and window then differ in size by a factor of three at most, and a
banded MinHash with one value a band finds the pair: an item at containment 0.8 agrees with a window in a
band with a probability of a quarter or more, and there are 64 bands.

With one value a band, an agreement means that the window holds the item's own minimum. So only windows
around an occurrence of some item's minimum can agree, and only for those the window's minimum is computed;
all other windows have no agreement by definition. Candidates are verified by the exact share of the
item's distinct shingles that the whole document holds. All steps are DataFrame expressions.

Spark keeps all rows that one document makes in memory until the last is made. So a place that meets a minimum takes
only the shingles around it along, not the document, and candidates are pairs of hashes of texts. The documents that
have some are read again, and each is compared with all its candidates in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.session import stored

WORDS = 5
CONTAINMENT = 0.8
BANDS = 64
#: Distinct item minima up to which they are broadcast; beyond, they are joined by shuffle.
BROADCAST_MINIMA = 200_000
#: Texts with a candidate up to which their hashes are broadcast, so that other documents are not shuffled.
BROADCAST_TEXTS = 1_000_000


def shingled(rows: DataFrame, keys: list[str], words: int = WORDS) -> DataFrame:
    """``keys`` and ``hashes``: the runs of ``words`` words of ``text`` as 64-bit hashes, in order.

    Words are runs of letters and digits, in lower case. With fewer words, or a null text, there are none.
    The words' hashes are a column of their own, so that they are made once a row and not once a run; for
    the same reason ``hashes`` is exploded as outer, since Spark would test it for emptiness beforehand.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    rows = rows.select(*keys, F.transform(F.split(plain, " "), lambda w: F.xxhash64(w)).alias("words"))
    starts = F.sequence(F.lit(0), F.size("words") - words)
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(words)]))
    none = F.array().cast("array<bigint>")
    return rows.select(*keys, F.when(F.size("words") >= words, runs).otherwise(none).alias("hashes"))


def _seed(band: Column) -> Column:
    """Bands differ in the top bits: the least ``hash ^ seed`` is the hash nearest to the seed, bit by bit."""
    return F.shiftleft(band.cast("long"), 64 - (BANDS - 1).bit_length())


def item_sets(items: DataFrame, words: int = WORDS) -> DataFrame:
    """For each text of items (item_id, text) its hash ``item``, its distinct shingles ``own``, and ``ids``.

    Items without a shingle are left out: nothing can be said of them.
    """
    named = items.select("item_id", F.xxhash64("text").alias("item"), "text")
    own = shingled(named, ["item_id", "item"], words).select("item_id", "item", F.array_distinct("hashes").alias("own"))
    return own.where(F.size("own") > 0).groupBy("item", "own").agg(F.collect_list(F.struct("item_id")).alias("ids"))


def item_minima(sets: DataFrame) -> DataFrame:
    """For each of ``item_sets`` its distinct minima: item, half, hash, seeds.

    ``half`` is half the largest size of the item's class, a power of two.
    """
    # sizes 1 to 2 are the first class, then 3 to 4, 5 to 8, ...
    half = F.greatest(F.lit(1), F.pow(2, F.ceil(F.log2(F.size("own"))) - 1)).cast("int")
    bands = sets.select("item", "own", half.alias("half"), F.explode_outer(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    seed = _seed(F.col("band"))
    least = F.array_min(F.transform("own", lambda h: h.bitwiseXOR(seed)))
    bands = bands.select("item", "half", seed.alias("seed"), least.bitwiseXOR(seed).alias("hash"))
    return bands.groupBy("item", "half", "hash").agg(F.collect_list("seed").alias("seeds"))


def _agreeing(near: DataFrame) -> DataFrame:
    """``near``'s ``print`` and ``item`` where ``hash`` is the minimum, in a band, of a window around its place ``at`` (from 0).

    The windows are the same for all places of a block of ``half``, so the first place in it stands for those with its hash.
    What is around is a column of its own that is exploded before it is tested: a test on the joined row itself would become
    part of the join, which would then make a row of each shingle of each document.
    """
    half, block = F.col("half"), F.floor(F.col("at") / F.col("half")).cast("int")
    before = F.slice("hashes", block * half + 1, F.col("at") - block * half)
    near = near.where(F.array_position(before, F.col("hash")) == 0)
    back = F.least(block, F.lit(2))
    around = F.slice("hashes", (block - back) * half + 1, (back + 3) * half)
    near = near.select("print", "item", "half", "hash", "seeds", back.alias("back"), F.explode_outer(F.array(around)).alias("around"))
    windows = F.transform(F.sequence(F.lit(0), F.col("back")), lambda k: F.slice("around", k * half + 1, 3 * half))

    def is_least(window: Column, seed: Column) -> Column:
        return F.array_min(F.transform(window, lambda h: h.bitwiseXOR(seed))) == F.col("hash").bitwiseXOR(seed)

    agree = F.exists(windows, lambda window: F.exists("seeds", lambda seed: is_least(window, seed)))
    return near.where(agree).select("print", "item")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    words: int = WORDS,
    broadcast_minima: int = BROADCAST_MINIMA,
    broadcast_texts: int = BROADCAST_TEXTS,
) -> DataFrame:
    """One row for each document and item it holds: doc_id, item_id, n_shared, n_item, containment.

    ``docs`` has doc_id and text, ``items`` item_id and text. ``n_item`` counts the item's distinct shingles, and
    ``n_shared`` those of them that the document holds: at least the share ``containment``. Null, empty and
    short texts (fewer than ``words`` words) hold nothing and are held by nothing. Rows with a repeated id give
    one row, with the greatest share; other columns are ignored. The candidates are stored in the shared folder.
    """
    sets = item_sets(items, words)
    minima = item_minima(sets)
    texts = docs.select("doc_id", F.xxhash64("text").alias("print"), "text")
    held = shingled(texts, ["print"], words)
    if minima.count() <= broadcast_minima:
        near = held.select("print", "hashes", F.posexplode_outer("hashes").alias("at", "hash"))
        near = near.join(F.broadcast(minima), "hash")
    else:  # only places and hashes are shuffled; documents come back for those that met a minimum
        held = held.withColumn("row", F.monotonically_increasing_id())
        places = held.select("row", F.posexplode_outer("hashes").alias("at", "hash"))
        near = places.join(minima, "hash").join(held, "row")
    pairs = stored(_agreeing(near).distinct(), "candidates")

    some = pairs.select("print").distinct()
    texts = texts.join(F.broadcast(some) if some.count() <= broadcast_texts else some, "print", "left_semi")
    candidates = pairs.join(sets, "item").groupBy("print").agg(F.collect_list(F.struct("ids", "own")).alias("candidates"))
    both = shingled(texts, ["doc_id", "print"], words).join(candidates, "print")

    def shared(candidate: Column) -> Column:
        n = F.size(F.array_intersect(candidate["own"], F.col("hashes"))).cast("long")
        return F.struct(candidate["ids"].alias("ids"), n.alias("n_shared"), F.size(candidate["own"]).cast("long").alias("n_item"))

    found = both.select("doc_id", F.inline_outer(F.transform("candidates", shared)))
    found = found.where(F.col("n_shared") >= F.lit(containment) * F.col("n_item"))
    found = found.select("doc_id", F.inline("ids"), "n_shared", "n_item")
    best = found.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))
    return best.withColumn("containment", F.col("n_shared") / F.col("n_item"))
