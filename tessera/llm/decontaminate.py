"""Benchmark passages in documents, by a prefix-filtered join of shingles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.llm.common import stored

#: What ends a word: ASCII characters but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW, SHINGLE = 10, 5
#: Shingles or windows that are broadcast at once, and bytes of their words;
#: more come in blocks, each against all documents.
BLOCK, BLOCK_BYTES = 1 << 18, 1 << 25


def words(text: Column) -> Column:
    """Words of a text, with A-Z lowered and nothing else; null has none."""
    low = lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER))
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), ""), low)


def shingles(w: Column, k: int) -> Column:
    """64-bit hash of each run of k words, in order."""
    n = F.size(w)
    run = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), run)).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(windows, owners): distinct runs of `window` words of items, or a shorter
    item's words, with the hashes of their shingles; and window, item_id pairs."""
    w = F.col("words")
    split = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    size = F.least(F.size(w), F.lit(window))
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.slice(w, i, size))
    each = stored(split.select("item_id", F.explode(runs).alias("words")).distinct(), "item-windows")
    windows = stored(each.select("words").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    hashes = reduce(lambda rest, k: F.when(F.size(w) == k, shingles(w, k)).otherwise(rest), range(1, shingle), shingles(w, shingle))
    return windows.withColumn("hashes", hashes), each.join(windows, "words").select("window", "item_id")


def blocks(df: DataFrame, column: str, size: Column, most: int) -> list[DataFrame]:
    """df in parts of about `most` rows and BLOCK_BYTES of `size`, by hash of a
    column without repeats."""
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    n = max(-(-rows // most), -(-held // BLOCK_BYTES))
    part = F.pmod(F.xxhash64(F.lit("block"), column), F.lit(max(n, 1)))
    return [df.filter(part == b) for b in range(n)]


def occurrences(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """row, words, hash and place of the shingles of each document, of all the
    lengths that windows need, one list behind the other."""
    w = F.col("words")
    every = F.concat(*[shingles(w, k) for k in lengths])
    return docs.select("row", "words", F.posexplode(every).alias("place", "hash"))


def start_of(place: Column, n: Column, k: Column, lengths: list[int]) -> Column:
    """Where in the document a shingle of k words begins, by its place among the
    shingles of all lengths."""
    before, out = F.lit(0), F.lit(None).cast("int")
    for length in lengths:
        out = F.when(k == length, place - before).otherwise(out)
        before = before + F.greatest(n - length + 1, F.lit(0))
    return out


def found_windows(docs: DataFrame, windows: DataFrame, shingle: int, block: int) -> DataFrame:
    """row, start, size and window of each place in `docs` where all words of a
    window stand.

    A window can only stand where each of its shingles does, so one of them is
    enough to look for: the rarest in `docs`. A window of which some shingle is
    nowhere is nowhere. The shingle's place in the window gives where the window
    would begin and end; both have to lie within the document, and then all its
    words are compared."""
    lengths = sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(shingle)).alias("k")).distinct().collect())  # `shingle` rows at most
    if not lengths:
        return docs.select("row", F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("window")).limit(0)
    tokens = stored(windows.select(F.explode("hashes").alias("hash")).distinct(), "item-shingles")
    seen = [occurrences(docs, lengths).select("hash").join(F.broadcast(b), "hash").groupBy("hash").agg(F.count("*").alias("n")) for b in blocks(tokens, "hash", F.lit(8), block)]
    rarity = stored(reduce(DataFrame.unionByName, seen), "shingle-counts")

    each = windows.select("window", "words", F.size("hashes").alias("many"), F.posexplode("hashes").alias("offset", "hash")).join(rarity, "hash")
    rarest = each.groupBy("window", "words", "many").agg(F.count("*").alias("seen"), F.min(F.struct("n", "hash", "offset")).alias("least"))
    rarest = stored(rarest.filter("seen = many").select("window", F.col("words").alias("wanted"), F.col("least.hash").alias("hash"), F.col("least.offset").alias("offset")), "prefixes")

    def verified(part: DataFrame) -> DataFrame:
        n, size = F.size("words"), F.size("wanted")
        start = start_of(F.col("place"), n, F.least(size, F.lit(shingle)), lengths) - F.col("offset")
        hits = occurrences(docs, lengths).join(F.broadcast(part), "hash")
        inside = (start >= 0) & (start + size <= n)
        same = F.slice("words", F.greatest(start, F.lit(0)) + 1, size) == F.col("wanted")
        return hits.filter(inside & same).select("row", start.alias("start"), size.alias("size"), "window")

    hits = [verified(b) for b in blocks(rarest, "window", F.octet_length(F.array_join("wanted", " ")), block)] or [verified(rarest)]
    return reduce(DataFrame.unionByName, hits)


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row.

    A window is any run of `window` words of an item, or all words of a shorter
    item; words of a document in any occurrence of a window are hit. n_items
    counts the items with a window in the document; the digest is of their ids,
    sorted as strings and joined by commas (none: of the empty text).

    Words are runs of ASCII letters and digits and of all that is not ASCII, with
    A-Z lowered. Null and empty texts, of either side, have no words. Rows that
    repeat an item_id are one item, windows that items share count for each; a
    null item_id hits words but is not among the items. Rows that repeat a doc_id
    are judged each; a null doc_id stays null. Extra columns are ignored; no
    items: nothing is hit; an empty table gives none.

    Expressions only, without Python in tasks. Words are split once and stored;
    windows are broadcast in blocks of at most `block`, each matched inside the
    scan of the documents, so no document is shuffled: only places of whole
    windows are, by row. Documents with the same windows share one look-up of
    the items, so a passage in many documents and many items is no product."""
    split = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"), F.monotonically_increasing_id().alias("row")), "document-words")
    windows, owners = item_windows(items, window, shingle)
    hits = found_windows(split, windows, shingle, block)

    upto = F.col("start") + F.col("size")
    earlier = W.partitionBy("row").orderBy("start", "size").rowsBetween(W.unboundedPreceding, -1)
    new = F.greatest(upto - F.greatest("start", F.coalesce(F.max(upto).over(earlier), F.lit(0))), F.lit(0))
    ids = F.array_sort(F.collect_set("window")).alias("windows")
    rows = stored(hits.select("row", "window", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"), ids), "hit-rows")

    sets = rows.select("windows").distinct()
    names = sets.select("windows", F.explode("windows").alias("window")).join(owners, "window")
    listed = F.array_sort(F.collect_set("item_id"))
    sets = names.groupBy("windows").agg(listed.alias("items"))
    told = rows.join(sets, "windows", "left").select("row", "n_hit", "items")

    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return split.select("doc_id", "row", F.size("words").cast("long").alias("n_words")).join(told, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
