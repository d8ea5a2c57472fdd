"""Benchmark decontamination: SimHash over item-sized windows, a multi-index of Hamming blocks, exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

WORDS = 5
SIMILARITY = 0.8
RADIUS = 14


def words_of(text: str) -> Column:
    """Lower-cased runs of letters and digits; null text: none."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: str, size: int) -> Column:
    """64-bit hash of every run of ``size`` words, in order."""
    hashed = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return F.expr(f"CASE WHEN size({words}) >= {size} THEN transform(sequence(0, size({words}) - {size}), i -> xxhash64({hashed})) END")


def shingles(words: str) -> Column:
    """Every run of WORDS words as text; fewer words are one run."""
    n = f"least({WORDS}, size({words}))"
    return F.expr(f"transform(sequence(1, greatest(1, size({words}) - {n} + 1)), i -> array_join(slice({words}, i, {n}), ' '))")


def simhash(words: str) -> Column:
    """64-bit SimHash of a window's words, each weighted by how often it occurs."""
    step = "(sums, h) -> transform(sums, (s, b) -> s + CAST(shiftrightunsigned(h, b) & 1L AS INT) * 2 - 1)"
    sums = f"aggregate(transform({words}, w -> xxhash64(w)), array_repeat(0, 64), {step})"
    return F.expr(f"aggregate(transform({sums}, (s, b) -> if(s > 0, shiftleft(1L, b), 0L)), 0L, (x, y) -> x | y)")


def blocks_of(fp: str, radius: int) -> Column:
    """The fingerprint's radius + 1 blocks of bits."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    return F.array(*[F.shiftrightunsigned(F.shiftleft(fp, a), 64 - (b - a)) for a, b in zip(edges, edges[1:])])


def weighted_similarity(a: str, b: str) -> Column:
    """Sum of the smaller counts over the sum of the larger counts of two lists of shingles."""
    count = "size(filter({0}, x -> x = one))"
    common = f"aggregate(array_intersect({a}, {b}), 0, (total, one) -> total + least({count.format(a)}, {count.format(b)}))"
    return F.expr(f"{common} / CAST(size({a}) + size({b}) - {common} AS DOUBLE)")


def leaks(
    docs: DataFrame, items: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, text_key, item_id, first_word, n_words, differing_bits, similarity): the items that each document holds.

    A document holds an item if a window of it as long as the item has a weighted similarity on five-word shingles of
    at least ``similarity`` with the item. Windows are laid where a shingle of the item occurs, so that it falls on
    the item's own place; a window without any shingle of an item has similarity zero and is not looked at. Every such
    window is compared exactly with the items that laid it, whatever their bits. Every window and every item also gets a
    SimHash, by which a window meets further items of its length: those that agree with it in one of radius + 1 blocks of
    bits, which holds for all that differ in ``radius`` bits at most; there too the exact similarity decides. So the
    radius takes no window from an item that lays it. At a document's ends windows are cut off. Of several windows for an item the most similar, then the first, is told.

    The scan of the texts sends on only positions that hold an item's shingle, summed by text, so equal texts are one
    group and long or hot ones stay small. Items of fewer than five words are matched as one shingle. Empty items and
    null texts match nothing. Repeated items and repeated rows each count. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    bench = items.select("item_id", words_of("text").alias("w")).filter("size(w) > 0")
    bench = cut(bench.select("item_id", F.size("w").alias("n"), shingles("w").alias("item_shingles"), simhash("w").alias("item_fp"), "w", F.xxhash64("w").alias("item")))
    sizes = sorted(r[0] for r in bench.select(F.least("n", F.lit(WORDS))).distinct().collect())  # 1 to WORDS at most
    source = docs.select(F.md5(F.col(text)).alias("text_key"), words_of(text).alias("w"))
    found = None
    for size in sizes:
        of_size = bench.filter(F.least("n", F.lit(WORDS)) == size)
        wanted = cut(of_size.select("item", "n", F.posexplode(shingle_hashes("w", size)).alias("offset", "h")).groupBy("n", "offset", "h").agg(F.collect_set("item").alias("by")))
        here = source.select("text_key", F.size("w").alias("words"), F.posexplode(shingle_hashes("w", size)).alias("at", "h")).join(wanted, "h")
        start = F.greatest(F.lit(0), F.col("at") - F.col("offset"))
        end = F.least("words", F.col("at") - F.col("offset") + F.col("n"))
        part = here.select("text_key", "n", start.alias("start"), end.alias("end"), "by")
        found = part if found is None else found.union(part)
    kind = docs.schema[key].dataType.simpleString()
    if found is None:
        return spark.createDataFrame(
            [], f"`{key}` {kind}, text_key string, item_id {items.schema['item_id'].dataType.simpleString()}, first_word int, n_words int, "
            "differing_bits int, similarity double",
        )
    laid = found.groupBy("text_key", "start", "end", "n").agg(F.array_distinct(F.flatten(F.collect_set("by"))).alias("by"))
    places = cut(laid.groupBy("text_key").agg(F.collect_list(F.struct("start", "end", "n", "by")).alias("places")))
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).withColumn("text_key", F.md5("_text")).join(places, "text_key")
    windows = (
        texts.select("_key", "text_key", words_of("_text").alias("w"), "places")
        .select("_key", "text_key", "w", F.explode("places").alias("p"))
        .select("_key", "text_key", F.col("p.start").alias("start"), F.col("p.n").alias("n"), F.col("p.by").alias("by"), F.expr("slice(w, p.start + 1, p.end - p.start)").alias("w"))
    )
    marked = cut(windows.select("_key", "text_key", "start", "n", "by", "w", simhash("w").alias("fp")))
    by_block = marked.withColumn("blocks", blocks_of("fp", radius)).select("*", F.posexplode("blocks").alias("block", "bits"))
    item_blocks = bench.withColumn("item_blocks", blocks_of("item_fp", radius)).select(
        "item_id", "item", "n", "item_fp", "item_shingles", "item_blocks", F.posexplode("item_blocks").alias("block", "bits")
    )
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # a pair that agrees in several blocks is taken at the first of them
    first_block = F.expr("array_position(zip_with(blocks, item_blocks, (x, y) -> x = y), true) = block + 1")
    near = by_block.join(item_blocks, ["n", "block", "bits"]).filter(first_block).withColumn("differing_bits", bits).filter(
        (F.col("differing_bits") <= radius) & ~F.array_contains("by", F.col("item"))
    )
    laid_by = bench.select("item_id", "item", "n", "item_fp", "item_shingles")
    own = marked.withColumn("item", F.explode("by")).join(laid_by, ["item", "n"]).withColumn("differing_bits", bits)
    pair = ["_key", "text_key", "start", "w", "item_id", "item_shingles", "differing_bits"]
    exact = near.select(pair).union(own.select(pair)).withColumn("window_shingles", shingles("w")).withColumn("similarity", weighted_similarity("window_shingles", "item_shingles")).filter(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), F.size("w").alias("n_words"), (-F.col("differing_bits")).alias("bits"))).alias("b")
    return exact.groupBy("_key", "text_key", "item_id").agg(best).select(
        F.col("_key").alias(key), "text_key", "item_id", (-F.col("b.before")).alias("first_word"), F.col("b.n_words").alias("n_words"),
        (-F.col("b.bits")).cast("int").alias("differing_bits"), F.col("b.similarity").alias("similarity"),
    )


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """What the decontamination query returns: a row for each document and each item that it holds."""
    return leaks(docs, items).drop("text_key")


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all columns."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    df = docs.toDF(*names.values()).withColumn("text_key", F.md5(names[text]))
    held = cut(leaks(docs, items, key=key, text=text).select("text_key").distinct())
    return df.join(held, "text_key", "left_anti").select(*[F.col(v).alias(k) for k, v in names.items()])
