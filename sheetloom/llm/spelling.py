"""Spelling variants: near words by a bit-sliced position index over the vocabulary.

The index has one bitset per (position, letter): bit k is set where word k has that letter
there.  A word is looked up letter by letter.  One set holds the words without an error so
far, three hold those with exactly one - a replaced letter, one letter more in the
vocabulary's word (position shifted up), one less (shifted down); each letter moves all
words of a chunk by a few word-parallel operations.

The vocabulary is dealt so that two words one edit apart meet: the edit lies behind the
first ``AFFIX`` letters, which are then equal, or in front of the last ``AFFIX`` of them.
Each word thus stands in the group of its first and in that of its last letters.  A group
beyond ``CHUNK`` words is cut into chunks, and its pairs of chunks go to different tasks; a
task returns, per word, a count and the best near word, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetloom.session import durable

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLIP = 199              # one run in so many loses a letter
MIN_CHARS = 6
MIN_COUNT = 5
TIMES = 5               # how much more frequent a word's form must be
AFFIX = 3               # letters that near words share at one end; MIN_CHARS >= 2 * AFFIX
CHUNK = 16_384          # words of an index held by a task
LONG = 64               # longer words have the lowest bits, so that far positions stay short


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the texts' words, after the slips that their documents give them."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), 0)).alias("run"))
    lower = runs.where(F.length("run") >= min_chars).select(
        "doc_id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    mark = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), "run"))
    at = (F.col("mark") % F.length("run")).cast("int")
    word = F.when(F.col("mark") % SLIP == 0, F.concat(
        F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    ).otherwise(F.col("run"))
    return (lower.withColumn("mark", mark).select(word.alias("word"))
            .where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


class PositionIndex:
    """Bitsets over words, given as ``(word, n)``; the best word has the lowest bit."""

    def __init__(self, words: list[tuple[str, int]]):
        ranked = sorted(words, key=lambda w: (len(w[0]) <= LONG, -w[1], w[0]))
        self.words = ranked
        self.all = (1 << len(ranked)) - 1
        self.long = (1 << sum(len(w) > LONG for w, _ in ranked)) - 1
        self.at = self._sets((key, k) for k, (w, _) in enumerate(ranked) for key in enumerate(w, 1))
        self.length = self._sets((len(w), k) for k, (w, _) in enumerate(ranked))
        self.prefix = self._sets((w[:AFFIX], k) for k, (w, _) in enumerate(ranked))

    @staticmethod
    def _sets(marks) -> dict:
        members: dict = {}
        for key, k in marks:
            members.setdefault(key, []).append(k)
        sets = {}
        for key, bits in members.items():
            field = bytearray(bits[-1] // 8 + 1)
            for k in bits:
                field[k >> 3] |= 1 << (k & 7)
            sets[key] = int.from_bytes(field, "little")
        return sets

    def near(self, word: str) -> int:
        """The words exactly one inserted, deleted or replaced code point away, as bits."""
        at = self.at
        none, replaced, more, less = self.all, 0, 0, 0
        for i, letter in enumerate(word, 1):
            here = at.get((i, letter), 0)
            more = (more | none) & at.get((i + 1, letter), 0)
            less = (less & at.get((i - 1, letter), 0)) | none
            same = none & here
            replaced = (replaced & here) | (none ^ same)
            none = same
            if not (none | replaced | more | less):
                return 0
        size, length = len(word), self.length
        return ((replaced & length.get(size, 0)) | ((more | none) & length.get(size + 1, 0))
                | (less & length.get(size - 1, 0)))

    def best(self, near: int) -> tuple[str, int]:
        """The most frequent of some words, the smallest of equally frequent ones."""
        parts = [p for p in (near & self.long, near & ~self.long) if p]
        found = [self.words[(p & -p).bit_length() - 1] for p in parts]
        return min(found, key=lambda w: (-w[1], w[0]))


def _looked_up(asked: list[str], index: PositionIndex, by_end: bool):
    for word in asked:
        near = index.near(word)
        if by_end and near:         # those that share the first letters meet in that group
            near &= ~index.prefix.get(word[:AFFIX], 0)
        if near:
            form, n = index.best(near)
            yield word, near.bit_count(), form, n


def _groups(batches: Iterator[pa.RecordBatch]):
    """Runs of rows with one (by_end, affix, ask, index), whatever the batches' limits."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for by_end, affix, ask, held, asks, word, n in zip(*columns):
            mark = (by_end, affix, ask, held)
            if mark != key:
                if rows:
                    yield key, rows
                key, rows = mark, []
            rows.append((asks, word, n))
    if rows:
        yield key, rows


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for (by_end, *_), rows in _groups(batches):
        asked = [w for asks, w, _ in rows if asks != 1]
        held = [(w, n) for asks, w, n in rows if asks != 0]
        if len(held) and len(asked) and len(rows) > 1:
            out += _looked_up(asked, PositionIndex(held), by_end)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), NEAR.types)], schema=NEAR)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), NEAR.types)], schema=NEAR)


def near_words(vocabulary: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``word, n_near, near, near_n``: how many words are one edit away, and the best of them.

    ``vocabulary`` holds distinct words of at least ``2 * AFFIX`` code points with ``n``.
    Words without a near word have no row.
    """
    words = vocabulary.select("word", "n", F.explode(F.array(
        F.struct(F.lit(False).alias("by_end"), F.substring("word", 1, AFFIX).alias("affix")),
        F.struct(F.lit(True).alias("by_end"), F.expr(f"right(word, {AFFIX})").alias("affix")))).alias("g")
    ).select("word", "n", "g.by_end", "g.affix")
    sizes = (words.groupBy("by_end", "affix").agg(F.count("*").alias("m")).where("m > 1")
             .select("by_end", "affix", F.ceil(F.col("m") / chunk).cast("int").alias("chunks")))
    dealt = words.join(sizes, ["by_end", "affix"]).withColumn(
        "own", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
    # `asks`: 0 is looked up, 1 stands in the index, 2 does both (the chunk against itself)
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("own"))
    places = F.concat(
        F.array(F.struct(F.col("own").alias("ask"), F.col("own").alias("held"), F.lit(2).alias("asks"))),
        F.transform(others, lambda c: F.struct(F.col("own").alias("ask"), c.alias("held"), F.lit(0).alias("asks"))),
        F.transform(others, lambda c: F.struct(c.alias("ask"), F.col("own").alias("held"), F.lit(1).alias("asks"))))
    found = (
        dealt.select("by_end", "affix", "word", "n", F.explode(places).alias("p"))
        .select("by_end", "affix", "p.ask", "p.held", "p.asks", "word", "n")
        .repartition("by_end", "affix", "ask", "held")
        .sortWithinPartitions("by_end", "affix", "ask", "held")
        .mapInArrow(_search, "word string, n_near long, near string, near_n long"))
    # the smallest of equally frequent words: compare within the largest count
    return (found.groupBy("word", "near_n").agg(F.sum("n_near").alias("n_near"), F.min("near").alias("near"))
            .groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                 F.max_by("near", "near_n").alias("near"), F.max("near_n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of each ``word, form``: the forms followed to the last.

    A form is ``TIMES`` as frequent as its word, so a chain is short; each round doubles the
    steps taken.
    """
    now = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                      F.col("next").isNotNull().alias("moved"))
        after = durable(moved)
        if after.where("moved").isEmpty():
            return now
        now = after.select("word", "root")


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             times: int = TIMES, chunk: int = CHUNK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    Words are runs of Latin letters, A-Z lower-cased, some with a letter taken out by the
    rule of :func:`vocabulary`; they have at least ``min_chars`` code points (``2 * AFFIX``
    at least) and ``min_count`` occurrences.  ``n_near`` counts the words exactly one
    inserted, deleted or replaced code point away; ``form`` is the most frequent of them
    (of equals the smallest by code points) if it is ``times`` as frequent as the word,
    ``root`` the last of the forms followed on.

    Null and empty texts have no words, a null doc_id counts as the text ``null``, repeated
    rows count each; an empty table gives none.  Other columns are not read.
    """
    if min_chars < 2 * AFFIX:
        raise ValueError(f"min_chars must be at least {2 * AFFIX}")
    words = durable(vocabulary(docs, min_chars, min_count))
    joined = durable(
        words.join(near_words(words, chunk), "word", "left")
        .withColumn("has", F.coalesce(F.col("near_n") >= times * F.col("n"), F.lit(False)))
        .select("word", F.when(F.col("has"), F.col("near")).alias("form"), "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(F.col("has"), F.col("near_n")).alias("form_n")))
    last = roots(joined.where("form is not null"))
    return joined.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
