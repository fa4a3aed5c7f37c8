"""Find passages of benchmark items in documents, with DataFrame functions only.

A document is read through windows of the items' own sizes (in words).  Windows and items
are lists of five-word shingles; each gets a SimHash in which a shingle weighs as often as
it occurs.  A multi-index over ``BLOCKS`` blocks of the fingerprint finds every
(window, item) pair within ``RADIUS`` bits: such a pair differs in at most
``RADIUS // BLOCKS`` bits of some block, and every item is entered under all values that
near for each block.  Candidates are then compared exactly, by the weighted Jaccard
similarity of their shingles.

Windows are laid only where they can matter.  A window of m shingles that reaches
``SIMILARITY`` with an item of n shares at least s/(1+s) * (m+n) shingles with it (m is n,
or all that a shorter document has); moved right to its first shared shingle it loses
none.  So windows of a size start at shingles that some item of that size has (or
end with the document) and must hold that many of them; which item it might be is left to
the fingerprints.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.session import durable

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
BLOCKS = 7
RADIUS = 20               # 2 bits in a block; similarity 0.8 is about 10 bits
_NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for a null text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _NOT_WORD), lambda w: w != "")


def shingles(tokens: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order, repeats included.

    ``tokens`` is a column, not an expression: it is looked into once per word.
    """
    starts = F.when(F.size(tokens) >= width, F.sequence(F.lit(0), F.size(tokens) - width)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(width)]))


def _simhashed(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``df`` by its keys, with ``fp``: bit j is set if over half of the hashes set it.

    Each of 32 sums counts two bits, in the two halves of a 64-bit word.
    """
    lanes = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(lanes)) for i in range(32)]
    counted = (df.select(*keys, F.explode_outer(column).alias("h"))
               .groupBy(*keys).agg(F.count("*").alias("n"), F.array(*sums).alias("sums")))

    def bit(i: Column, half: int) -> Column:
        ones = F.shiftrightunsigned(F.get("sums", i), 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.call_function("shiftleft", (ones * 2 > F.col("n")).cast("long"), i + 32 * half)

    # a loop in place of 64 terms keeps plans and generated code small
    word = F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("long"),
                       lambda fp, i: fp.bitwiseOR(bit(i, 0)).bitwiseOR(bit(i, 1)))
    return counted.select(*keys, word.alias("fp"))


def _blocks() -> list[tuple[int, int]]:
    """(shift, width) of each block."""
    sizes = [BITS // BLOCKS + (i < BITS % BLOCKS) for i in range(BLOCKS)]
    return [(sum(sizes[:i]), n) for i, n in enumerate(sizes)]


def _entered(marked: DataFrame, near: int) -> DataFrame:
    """``marked`` (with ``fp``) under every ``block, value`` within ``near`` bits of its own."""
    codes = []          # block, its shift, its width and the bits to flip, in one number each
    for i, (shift, width) in enumerate(_blocks()):
        for k in range(near + 1):
            for flipped in combinations(range(width), k):
                codes.append(i | shift << 8 | width << 16 | sum(1 << b for b in flipped) << 24)
    code = F.col("code")
    shift, width = F.shiftright(code, 8).bitwiseAND(F.lit(255)), F.shiftright(code, 16).bitwiseAND(F.lit(255))
    own = F.call_function("shiftrightunsigned", F.col("fp"), shift.cast("int")).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), width.cast("int")) - 1)
    return marked.select("*", F.explode(F.lit(codes).cast("array<long>")).alias("code")).select(
        *marked.columns, code.bitwiseAND(F.lit(255)).cast("int").alias("block"),
        own.bitwiseXOR(F.shiftright(code, 24)).alias("value"))


def _similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two lists of hashes (a hash weighs as often as it occurs)."""
    plain = F.size(F.array_intersect(a, b))
    least = F.aggregate(
        F.array_intersect(a, b), F.lit(0),
        lambda s, h: s + F.least(F.size(F.filter(a, lambda x: x == h)), F.size(F.filter(b, lambda x: x == h))))
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    shared = F.when(once, plain).otherwise(least)
    return shared / (F.size(a) + F.size(b) - shared)


def _passages(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """Matches of items whose shingles have ``width`` words.

    ``docs``: doc_id, text_key, text; ``items``: item_key (of id and text), item_id, hashes.
    """
    wanted = items.select(F.size("hashes").alias("size"), F.explode("hashes").alias("h")).distinct()
    read = (docs.select("doc_id", "text_key", words(F.col("text")).alias("w"))
            .select("*", (F.size("w") - (width - 1)).alias("m")))
    # outer: else the optimiser repeats the whole expression in a filter on the scan
    spots = (read.select("doc_id", "text_key", "m", F.posexplode_outer(shingles(F.col("w"), width)).alias("at", "h"))
             .join(wanted, "h"))
    hits = spots.groupBy("doc_id", "text_key", "size").agg(
        F.sort_array(F.collect_set("at")).alias("hits"), F.first("m").alias("m"))
    share = SIMILARITY / (1 + SIMILARITY)       # of the shingles of the item and of the window
    need = F.ceil((F.col("size") + F.least("m", "size")) * F.lit(share) - F.lit(1e-9)).cast("int")
    held = F.filter(
        F.when(F.size("hits") >= need, F.sequence(F.lit(0), F.size("hits") - need)).otherwise(
            F.array().cast("array<int>")),
        lambda k: F.get("hits", k + need - 1) - F.get("hits", k) < F.col("size"))
    starts = (hits.select("doc_id", "text_key", "size", F.transform(held, lambda k: F.get("hits", k)).alias("starts"))
              .where(F.size("starts") > 0))
    starts = durable(starts)
    same = F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("s.text_key") == F.col("t.text_key"))
    texts = (docs.alias("t").join(starts.select("doc_id", "text_key").distinct().alias("s"), same, "left_semi")
             .select("doc_id", "text_key", words(F.col("text")).alias("w")).distinct()
             .select("doc_id", "text_key", shingles(F.col("w"), width).alias("all")))
    windows = (starts.alias("s").join(texts.alias("t"), same)
               .select("s.doc_id", "s.text_key", "size", "all", F.explode(
                   F.array_distinct(F.transform("starts", lambda s: F.greatest(
                       F.lit(0), F.least(s, F.size("all") - F.col("size")))))).alias("start"))
               .select("doc_id", "text_key", "size", "start",
                       F.slice("all", F.col("start") + 1, F.col("size")).alias("hashes"))
               .where(F.size("hashes") > 0))
    windows = durable(windows.withColumn("content", F.xxhash64("hashes")).dropDuplicates(
        ["doc_id", "text_key", "size", "start"]))
    # equal windows are searched once
    contents = durable(windows.groupBy("size", "content").agg(F.first("hashes").alias("hashes")))
    marked = _simhashed(contents, ["size", "content"], "hashes")
    probes = _entered(marked, 0)
    entered = _entered(
        _simhashed(items, ["item_key"], "hashes").join(items, "item_key")
        .select("item_key", F.size("hashes").alias("size"), "fp"),
        RADIUS // BLOCKS).withColumnRenamed("fp", "item_fp")
    candidates = (probes.join(entered, ["size", "block", "value"])
                  .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
                  .select("size", "content", "item_key").distinct())
    verified = (candidates.join(contents.withColumnRenamed("hashes", "mine"), ["size", "content"])
                .join(items, "item_key").withColumn("similarity", _similarity(F.col("mine"), F.col("hashes")))
                .where(F.col("similarity") >= SIMILARITY).select("size", "content", "item_id", "similarity"))
    return (windows.drop("hashes").join(verified, ["size", "content"])
            .groupBy("doc_id", "text_key", "item_id")
            .agg(F.max_by(F.struct("start", "size", "similarity"),
                          F.struct("similarity", -F.col("start"))).alias("best"))
            .select("doc_id", "text_key", "item_id", F.col("best.start").alias("start_word"),
                    (F.col("best.size") + width - 1).alias("n_words"), "best.similarity"))


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """As :func:`contaminated`, with the ``text_key`` of the row's text."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    tokens = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    widths = [r[0] for r in tokens.select(F.least(F.size("w"), F.lit(SHINGLE))).distinct().collect()]
    out = None
    for width in sorted(widths, reverse=True):
        items = durable(tokens.where(F.least(F.size("w"), F.lit(SHINGLE)) == width)
                        .select("item_id", shingles(F.col("w"), width).alias("hashes"))
                        .dropDuplicates(["item_id", "hashes"])
                        .withColumn("item_key", F.xxhash64("item_id", "hashes")))
        found = _passages(docs, items, width)
        out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], (
            "doc_id long, text_key long, item_id long, start_word int, n_words int, similarity double"))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, similarity``: the best window (the first of
    equals) of each document and item whose similarity reaches ``SIMILARITY``.

    Items of fewer than five words are one shingle, and match only word for word; items
    without words (or with null text) match nothing, as do documents without words.
    Repeated rows of a document give one row.  Rows of one doc_id with different texts are
    searched each; a null doc_id is a document like any other.  Equal items each match; rows
    of one item_id with different texts are searched for each, and so are items with a null
    item_id.  Columns besides doc_id, item_id and text are ignored; empty tables give no row.
    """
    return _found(docs, benchmark).drop("text_key")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in whose text no item was found.

    Each row is judged by its own text: of several rows with one doc_id, or with none,
    those without an item stay.
    """
    found = _found(docs, benchmark).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    return docs.join(found, same, "left_anti")
