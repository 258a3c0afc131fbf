"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item's windows are sets of consecutive shingles. A document contains a window exactly
when all its shingles follow one another there, so with containment 1 the necessary prefix
is one shingle: the rarest. Rarity is counted over all documents, among the shingles that
the benchmark has. Documents are then joined on those prefix shingles alone; the position
of the shingle gives the only place the window can start, length bounds drop starts outside
the text, and a slice comparison verifies the words.

Words are compared as text. Shingles are 64-bit hashes, used to find candidates only, so a
hash collision costs a comparison and changes nothing.

One plan serves every size of either table. The tasks that split texts hold a bitmap of the
benchmark's shingles, whose size does not depend on the data, and drop all other places before
anything shuffles. What passes carries the few words around it, so texts never move; a prefix
shingle that is frequent in the documents is split into parts by its count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import frames

WINDOW = 13
SHINGLE = 3
#: The bitmap has at most this many rows of 64 bits: 4 MB of bits, 33 million places. More shingles only let more rows pass.
BITMAP_ROWS = 1 << 19
#: Rows that stand for documents have no shingle to be dealt by; they are dealt into so many parts.
DOCUMENT_PARTS = 1 << 16
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Runs of ASCII letters, digits and all characters beyond ASCII, in their own case; null has none."""
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), _NOT_WORD), "")


def folded(array: Column) -> Column:
    """The words with A-Z in lower case and every other letter as it is."""
    return F.split(F.translate(F.array_join(array, " "), _UPPER, _LOWER), " ")


def _shingle(array: str, width: int) -> Column:
    """Hash of ``width`` words from the 1-based place ``at``, blind to the case of all letters.

    ``lower`` on a whole word is much faster than a translation of A-Z; as it joins more words
    than A-Z does, it can only add candidates, which the comparison of ``folded`` words then drops.
    """
    return F.xxhash64(F.lit(width), *[F.lower(F.get(array, F.col("at") + (k - 1))) for k in range(width)])


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``window_id``, ``window_words`` and the sorted ids of the items that have it.

    Items without words have none; an item shorter than the window is one window. A window of
    an item without an id is kept with an empty list of ids.
    """
    n = F.size("w")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))))
    rows = (
        benchmark.select(F.col(item).cast("string").alias("item"), words(text).alias("w"))
        .where(n > 0)
        .withColumn("w", folded(F.col("w")))
        .select("item", "w", starts.alias("start"))
        .select("item", F.slice("w", F.col("start"), window).alias("window_words"))
    )
    sets = rows.groupBy("window_words").agg(F.collect_set("item").alias("items"))
    return sets.withColumn("window_id", F.xxhash64("window_words"))


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Every shingle of every window with its distance from the window's first word."""
    width = F.least(F.size("window_words"), F.lit(shingle))
    return windows.select(
        "*", width.alias("width"), F.explode(F.sequence(F.lit(0), F.size("window_words") - width)).alias("distance")
    ).withColumn(
        "shingle",
        F.expr(
            "CASE width "
            + " ".join(
                f"WHEN {k} THEN xxhash64({k}, " + ", ".join(f"lower(get(window_words, distance + {j}))" for j in range(k)) + ")"
                for k in range(1, shingle + 1)
            )
            + " END"
        ),
    )


def _places(texts: DataFrame, keep: Sequence[str], widths: Sequence[int]) -> DataFrame:
    """One row per word place ``at`` (1-based) and shingle width, and one per document with ``at`` 0 and no shingle.

    The outer generator keeps Spark from deriving a filter that would split every text a second time.
    """
    n = len(widths)
    # One generator for places and widths: rows with all words exist only inside it, never between two operators.
    step = F.explode_outer(F.sequence(F.lit(0), F.size("w") * n))
    at = F.when(F.col("step") > 0, F.floor((F.col("step") - 1) / n) + 1).otherwise(0).cast("int")
    placed = texts.select(*keep, "w", step.alias("step")).withColumn("at", at)
    shingle = F.lit(None).cast("long")
    for j, k in enumerate(widths):
        own = (F.col("at") > 0) & ((F.col("step") - 1) % n == j) & (F.col("at") + (k - 1) <= F.size("w"))
        shingle = F.when(own, _shingle("w", k)).otherwise(shingle)
    return placed.withColumn("shingle", shingle).drop("step")


_BIT = "pmod(shiftrightunsigned(shingle, 32), 64)"


def _bitmap(shingles: DataFrame) -> DataFrame:
    """``slot`` and ``bits``: one bit set for every shingle, in at most ``BITMAP_ROWS`` rows."""
    return frames.materialize(
        shingles.select(F.pmod("shingle", F.lit(BITMAP_ROWS)).alias("slot"), F.expr(f"shiftleft(1L, cast({_BIT} as int))").alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or("bit").alias("bits"))
    )


def _passing(places: DataFrame, bitmap: DataFrame, how: str) -> DataFrame:
    """Places whose bit is set, and with ``how`` "left" also the rows that stand for documents."""
    slotted = places.withColumn("slot", F.pmod("shingle", F.lit(BITMAP_ROWS)))
    passes = F.expr(f"coalesce(getbit(bits, cast({_BIT} as int)) = 1, false)")
    if how == "left":
        passes = passes | (F.col("at") == 0)
    return slotted.join(F.broadcast(bitmap), "slot", how).where(passes)


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    hot_rows: int = frames.HOT_LEAST,
) -> DataFrame:
    """One row per document, ``start`` null, with ``n_words``; and one per occurrence of a window.

    Occurrence rows add ``start`` (1-based word), ``length`` and ``items``. Rows carry ``keep``. Repeated
    documents give repeated rows. A prefix shingle found more than ``hot_rows`` times, and in more than
    1 / ``frames.HOT_PARTS`` of all places that prefix shingles have, is joined in parts of that size.
    """
    windows = frames.materialize(benchmark_windows(benchmark, window=window))
    shingles = _window_shingles(windows, shingle)
    widths = [r.width for r in shingles.select("width").distinct().orderBy("width").collect()]  # at most ``shingle`` rows
    texts = docs.select(*keep, words(text).alias("w"))
    if not widths:
        return texts.select(*keep, F.size("w").alias("n_words"), F.lit(None).cast("int").alias("start"),
                            F.lit(None).cast("int").alias("length"), F.lit(None).cast("array<string>").alias("items"))

    # Rarity: how often each benchmark shingle occurs in the documents, counted with map-side sums.
    seen = _places(texts.select("w"), (), widths).where("shingle IS NOT NULL").select("shingle")
    counts = _passing(seen, _bitmap(shingles), "inner").groupBy("shingle").agg(F.count(F.lit(1)).alias("n_seen"))
    rarity = shingles.join(counts, "shingle", "left").withColumn("n_seen", F.coalesce("n_seen", F.lit(0)))
    # A window has at most ``window`` shingles. One that never occurs rules its window out.
    order = Window.partitionBy("window_words").orderBy("n_seen", "distance")
    prefix = frames.materialize(
        rarity.withColumn("place", F.row_number().over(order))
        .where((F.col("place") == 1) & (F.col("n_seen") > 0))
        .select("shingle", "n_seen", "distance", "window_words", "items")
    )
    # Places of a hot shingle are spread by a hash. Fewer than ``HOT_PARTS`` shingles can be hot.
    each = prefix.select("shingle", "n_seen").distinct()
    limit = max(hot_rows, (each.agg(F.sum("n_seen")).first()[0] or 0) // frames.HOT_PARTS)
    hot = frames.materialize(each.where(F.col("n_seen") > limit).select("shingle", F.ceil(F.col("n_seen") / limit).cast("int").alias("ways")))
    ways = F.coalesce("ways", F.lit(1))
    rare = prefix.drop("n_seen").join(F.broadcast(hot), "shingle", "left").withColumn("part", F.explode(F.sequence(F.lit(0), ways - 1)))

    # The row with at = 0 stands for the document itself, so texts are split once. No window reaches further than the words around.
    first = F.greatest(F.col("at") - (window - 1), F.lit(1))
    itself = F.col("at") == 0
    near = _passing(_places(texts, keep, widths), _bitmap(prefix), "left").select(
        *keep, "at", "shingle", F.size("w").alias("n_words"), F.when(~itself, F.slice("w", first, 2 * window - 1)).alias("around")
    )
    dealt = F.xxhash64(*keep, "at")
    spread = near.join(F.broadcast(hot), "shingle", "left").withColumn(
        "part", F.when(itself, F.pmod(dealt, F.lit(DOCUMENT_PARTS))).otherwise(F.pmod(dealt, ways)).cast("int")
    )
    met = spread.drop("ways").join(rare.drop("ways"), ["shingle", "part"], "left")
    start, length = F.col("at") - F.col("distance"), F.size("window_words")
    there = folded(F.slice("around", F.greatest(start - first + 1, F.lit(1)), F.greatest(length, F.lit(0))))
    real = F.col("window_words").isNotNull() & (start >= 1) & (start + length - 1 <= F.col("n_words")) & (there == F.col("window_words"))
    return met.where(itself | F.coalesce(real, F.lit(False))).select(
        *keep, "n_words", *[F.when(~itself, c).alias(n) for c, n in ((start, "start"), (length, "length"), (F.col("items"), "items"))]
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    share: int = 20,
    hot_rows: int = frames.HOT_LEAST,
) -> DataFrame:
    """Per document: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window; a document is contaminated
    with ``n_hit > 0`` and ``share * n_hit >= n_words``. Null and empty texts have no words.
    Rows that repeat key and text give one row each, with equal results; rows with a null key
    are told apart by their text. An empty benchmark leaves every document clean.
    """
    keyed = docs.select(key, F.xxhash64(text).alias("text_hash"), F.length(text).alias("text_length"), F.col(text))
    by = [key, "text_hash", "text_length"]
    rows = occurrences(keyed, benchmark, by, text, window, shingle, hot_rows)
    # Rows of one text: as many as the text has occurrences. Running end of what is covered so far.
    spot = Window.partitionBy(*by).orderBy(F.col("start").asc_nulls_first(), "length")
    before = F.max(F.col("start") + F.col("length")).over(spot.rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("length")
    fresh = F.greatest(end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))), F.lit(0))
    found = rows.withColumn("fresh", F.coalesce(fresh, F.lit(0)))
    per_text = found.groupBy(*by).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sum("fresh").cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.sum(F.when(F.col("start").isNull(), 1).otherwise(0)).alias("copies"),
    )
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return per_text.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
        again.alias("copy"),
    ).drop("copy")


def items_digest() -> Column:
    """SHA-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.concat_ws(",", "items"), 256)


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents; columns, whatever their names, and repeated rows stay.

    Null and empty texts and null keys are kept, as is everything where the benchmark is empty. An empty table stays empty. The texts themselves never shuffle: the list of contaminated rows is joined by key and text hash.
    """
    marks = [F.xxhash64(text).alias("dc_hash"), F.length(text).alias("dc_length")]
    # The row travels as one struct, so no column of it can clash.
    named = docs.select(F.struct("*").alias("doc"), F.col(key).alias("dc_own"), *marks)
    keyed = docs.select(F.col(key).alias("dc_key"), *marks, F.col(text).alias("dc_text"))
    by = ["dc_key", "dc_hash", "dc_length"]
    rows = occurrences(keyed, benchmark, by, "dc_text", **options).where("start IS NOT NULL")
    spot = Window.partitionBy(*by).orderBy("start", "length")
    before = F.max(F.col("start") + F.col("length")).over(spot.rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("length")
    fresh = F.greatest(end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))), F.lit(0))
    bad = (
        rows.withColumn("fresh", fresh).groupBy(*by)
        .agg(F.sum("fresh").alias("n_hit"), F.max("n_words").alias("n_words"))
        .where(F.col("n_hit") * 20 >= F.col("n_words"))
    )
    same = (
        F.col("dc_own").eqNullSafe(F.col("dc_key"))
        & (named["dc_hash"] == bad["dc_hash"])
        & named["dc_length"].eqNullSafe(bad["dc_length"])
    )
    return named.join(bad, same, "left_anti").select("doc.*")
