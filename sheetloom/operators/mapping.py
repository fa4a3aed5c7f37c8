"""Label → canonical name, by alias dictionaries.

A dictionary of a handful of configured names travels as an array literal inside the
expression: matching is then a per-row projection, with no join and no shuffle.  A large
one is a table, and distinct labels find their candidates by an inverted index of n-grams:
where one text lies within another, each n-gram of the one is among those of the other, so
its rarest n-gram leads to all texts that may hold it.  Both give the same matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.contracts import MAPPING_COLUMNS
from sheetloom.functions.text import analyte_label, mapping_label, ratio_text, strip
from sheetloom.sources.canonical import CanonicalNames, DEFAULT_NAMES

# Confidences of the deterministic mapper.
EXACT = 0.95
PARTIAL_BASE, PARTIAL_SPAN, PARTIAL_CAP = 0.4, 0.6, 0.5
ANALYTE_PARTIAL, ANALYTE_PARTIAL_SHORT, ANALYTE_LONG = 0.7, 0.55, 5
SLUG_CONFIDENCE = 0.30
REVIEW_BELOW = 0.5

GRAM = 3                # letters of the longest n-grams
LITERAL_ALIASES = 200   # aliases up to which a dictionary is a literal

SOURCE_DETERMINISTIC = "mock_synonyms"
SLUG_RATIONALE = "no canonical analyte match — slug fallback"


def _alias_array(names: dict[str, list[str]]) -> Column:
    entries = CanonicalNames.flatten(names)
    if not entries:
        return F.array().cast("array<struct<canonical:string,alias:string,ord:int>>")
    return F.array(*[F.struct(F.lit(c).alias("canonical"), F.lit(a).alias("alias"),
                              F.lit(o).alias("ord")) for c, a, o in entries])


def _ranked(label: Column, key: Column, canonical: Column, alias: Column, order: Column,
            confidence: Column) -> Column:
    """An alias that touches a label, as a struct whose greatest value is the best alias:
    exact beats partial, then the higher confidence, then the earlier alias."""
    exact = key == label
    return F.struct(
        exact.alias("exact"), F.when(exact, EXACT).otherwise(confidence).alias("confidence"),
        (-order).alias("earliness"), canonical.alias("canonical"), alias.alias("alias"),
        F.length(alias).alias("size"))


def _best(label: Column, aliases: Column, key, confidence) -> Column:
    """Best alias of an array of them; null when nothing matches.

    ``key`` is the alias text as compared, ``confidence`` that of a partial match.
    """
    touching = F.filter(aliases, lambda a: label.contains(key(a["alias"])) | key(a["alias"]).contains(label))
    return F.array_max(F.transform(touching, lambda a: _ranked(
        label, key(a["alias"]), a["canonical"], a["alias"], a["ord"], confidence(a["alias"]))))


def _grams(text: Column, size: Column | int) -> Column:
    """The substrings of one size; none where the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array())
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, size)))


def _gram_index(texts: DataFrame, name: str) -> DataFrame:
    """``gram, <name>`` for every n-gram of up to ``GRAM`` letters, the empty one included."""
    sizes = F.concat(F.array(F.lit("")), *[_grams(F.col(name), n) for n in range(1, GRAM + 1)])
    return texts.select(name, F.explode(sizes).alias("gram"))


def _holders(texts: DataFrame, name: str, index: DataFrame, holder: str) -> DataFrame:
    """Pairs of a text and a longer or equal one that holds it."""
    size = F.least(F.length(name), F.lit(GRAM))
    own = texts.select(name, F.explode(F.when(F.length(name) == 0, F.array(F.lit("")))
                                       .otherwise(_grams(F.col(name), size))).alias("gram"))
    known = index.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = (own.join(known, "gram").groupBy(name)
              .agg(F.min(F.struct("n", "gram")).alias("least")).select(name, F.col("least.gram").alias("gram")))
    return rarest.join(index, "gram").where(F.col(holder).contains(F.col(name))).select(name, holder)


def _best_by_index(labels: DataFrame, names: dict[str, list[str]], key, confidence) -> DataFrame:
    """``_norm, _best`` of the distinct labels that touch an alias."""
    aliases = (CanonicalNames.frame(labels.sparkSession, names)
               .withColumn("_key", key(F.col("alias"))))
    texts, keys = labels.select("_norm").distinct(), aliases.select("_key").distinct()
    by_label, by_key = _gram_index(texts, "_norm"), _gram_index(keys, "_key")
    touching = _holders(keys, "_key", by_label, "_norm").unionByName(_holders(texts, "_norm", by_key, "_key"))
    ranked = touching.join(aliases, "_key").select("_norm", _ranked(
        F.col("_norm"), F.col("_key"), F.col("canonical"), F.col("alias"), F.col("ord"),
        confidence(F.col("alias"))).alias("best"))
    return ranked.groupBy("_norm").agg(F.max("best").alias("_best"))


def _with_best(labels: DataFrame, norm: Column, names: dict[str, list[str]], key, confidence) -> DataFrame:
    """Add ``_norm`` and ``_best``."""
    normed = labels.withColumn("_norm", norm)
    if sum(map(len, names.values())) <= LITERAL_ALIASES:
        return normed.withColumn("_best", _best(F.col("_norm"), _alias_array(names), key, confidence))
    return normed.join(_best_by_index(normed, names, key, confidence), "_norm", "left")


def match_meta(labels: DataFrame, names: CanonicalNames = DEFAULT_NAMES,
               label: str = "raw_label") -> DataFrame:
    """Add canonical, confidence and rationale of a row-level label."""
    size = F.greatest(F.length("_norm"), F.lit(1))

    def partial(alias: Column) -> Column:
        coverage = F.length(alias).cast("double") / size
        return F.lit(PARTIAL_BASE) + F.least(F.lit(PARTIAL_CAP), coverage * PARTIAL_SPAN)

    rationale = (
        F.when(F.col("_best").isNull(), "no synonym match")
        .when(F.col("_best.exact"),
              F.concat(F.lit("exact synonym match: '"), F.col("_best.alias"), F.lit("'")))
        .otherwise(F.concat(
            F.lit("substring match against '"), F.col("_best.alias"), F.lit("' (coverage="),
            ratio_text(F.col("_best.size"), size), F.lit(")"))))
    return (
        _with_best(labels, mapping_label(F.col(label)), names.synonyms, lambda alias: alias, partial)
        .withColumn("canonical", F.col("_best.canonical"))
        .withColumn("confidence", F.coalesce("_best.confidence", F.lit(0.0)))
        .withColumn("rationale", rationale)
        .drop("_norm", "_best")
    )


def match_analyte(labels: DataFrame, names: CanonicalNames = DEFAULT_NAMES,
                  label: str = "raw_label") -> DataFrame:
    """Add canonical, confidence and rationale of a measured label (no fallback)."""
    def partial(alias: Column) -> Column:
        return (F.when(F.length(analyte_label(alias)) >= ANALYTE_LONG, ANALYTE_PARTIAL)
                .otherwise(ANALYTE_PARTIAL_SHORT))

    rationale = (
        F.when(F.col("_best").isNull(), "no analyte match")
        .when(F.col("_best.exact"),
              F.concat(F.lit("exact analyte alias: '"), F.col("_best.alias"), F.lit("'")))
        .otherwise(F.concat(F.lit("substring match against analyte alias '"),
                            F.col("_best.alias"), F.lit("'"))))
    return (
        _with_best(labels, analyte_label(F.col(label)), names.analytes, analyte_label, partial)
        .withColumn("canonical", F.col("_best.canonical"))
        .withColumn("confidence", F.coalesce("_best.confidence", F.lit(0.0)))
        .withColumn("rationale", rationale)
        .drop("_norm", "_best")
    )


def slug(label: Column) -> Column:
    """Stable stand-in name of a measured label without canonical name."""
    words = F.regexp_replace(strip(label), "[^A-Za-z0-9]+", "_")
    return F.concat(F.lit("unknown_"), F.trim(words, F.lit("_")))


def map_columns_deterministic(columns: DataFrame, names: CanonicalNames = DEFAULT_NAMES
                              ) -> DataFrame:
    """Give every sheet column its role and canonical name.

    ``columns`` is ``sheet_columns``; its attributes stay alongside, so no later
    join back is needed.  ``position`` orders the mappings within a sheet.
    """
    meta = match_meta(columns.where(F.col("kind") == "meta"), names).withColumn(
        "role", F.when(F.col("canonical").isNull(), "ignored").otherwise("meta"))
    measured = match_analyte(columns.where(F.col("kind") == "analyte"), names)
    unmatched = F.col("canonical").isNull()
    measured = (
        measured
        .withColumn("rationale", F.when(unmatched, SLUG_RATIONALE).otherwise(F.col("rationale")))
        .withColumn("confidence", F.when(unmatched, SLUG_CONFIDENCE).otherwise(F.col("confidence")))
        .withColumn("canonical", F.coalesce("canonical", slug(F.col("raw_label"))))
        .withColumn("role", F.lit("analyte"))
    )
    return (
        meta.unionByName(measured)
        .withColumn("source", F.lit(SOURCE_DETERMINISTIC))
        .withColumn("position", F.col("column_index"))
    )


def mapping_log(mapped: DataFrame) -> DataFrame:
    return mapped.select(*MAPPING_COLUMNS)
