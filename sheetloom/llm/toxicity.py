"""Toxicity of whole texts by a weighted finite-state grammar over clauses.

Words are read as symbols: insult, threat, target, negation, report, quotation mark or
other.  Five transducers, given as state tables, are composed into one machine
(:mod:`sheetloom.llm.transducers`) that reads the symbols of a clause:

* negation  - writes an insult or threat within three words after a negation as a weak one;
* report    - takes off from what follows a verb of speech, or stands in quotes;
* insult    - counts an insult, weak or not;
* target    - guesses whether a person is in the clause, and then adds to its insults;
* threat    - guesses that a person follows within four words; a threat counts only then.

A wrong guess ends in no final state; the clause's weight is that of the best path.  The
document's log-odds are a base plus the weights of its densest stretch of clauses (a
character between them costs ``PER_CHARACTER``), less the logarithm of the chances that its
length gives to accidental matches: a passage counts nearly the same in a long text as
alone.  Isolated words have no weight of their own.

Which words are insults is learned from labels: whole words, and stems (word beginnings)
that stand for many words.  Evidence is counted by distinct neighbours (word after word),
so that a passage in a thousand copies counts once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.llm.transducers import compose, machine

TRAIN_ROWS = 8_000       # labelled rows that a lexicon is fitted on, at most about
LEXICON_SIZE = 4_096      # entries of a lexicon
MIN_DOCS = 3              # toxic texts that an entry needs
MIN_EVIDENCE = 8          # half the sum of its toxic texts and their neighbour pairs
MIN_LOG_ODDS = 2.3        # below about 3, one match in a document is not enough
CLEAN_PRIOR = 2.0         # clean texts that every entry is taken to have
STEM_LENGTHS = (4, 5, 6, 7, 8)
MIN_STEM_WORDS = 2        # different words of one text that a stem must cover
THRESHOLD = 0.3

BASE = math.log(0.02 / 0.98)      # log-odds of a text without a matched clause
PER_CHARACTER = 0.0006            # taken off within a stretch of clauses: chance matches grow with it
CHANCE = 1_000                    # characters that give one chance to an accidental match
NEGATED, REPORTED, TARGETED = 0.4, 0.5, 1.25
THREAT = 5.0
REACH = 240               # characters that a clause without punctuation extends around a match

TARGETS = frozenset("you your yours youre he she they him her them du dich dir ihr euch sie "
                    "tu te toi vous il elle ils tú ti usted ustedes él ella ellos".split())
NEGATIONS = frozenset("not no never isnt arent wasnt dont doesnt didnt without nicht kein keine nie "
                      "niemals ne pas jamais aucun nunca jamás sin".split())
REPORTS = frozenset("said says wrote called claimed quoted quote reported sagte schrieb nannte "
                    "disait écrit appelé dijo escribió llamó".split())
THREATS = frozenset("kill hurt destroy beat burn stab shoot strangle töten umbringen verprügeln "
                    "tuer frapper détruire matar golpear destruir".split())

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_END = re.compile(r"[.!?;\n]")


# --- grammar ----------------------------------------------------------------------

# I insult, T threat, Y person, N negation, R report, Q quotation mark, O other word;
# i and t are a weak insult and threat
NEGATION = machine(
    [0], range(4),
    [(0, "ITYRO", None, 1.0, 0)]
    + [(k, "N", None, 1.0, 3) for k in range(4)] + [(k, "Q", None, 1.0, k) for k in range(4)]
    + [(k, "YRO", None, 1.0, k - 1) for k in (1, 2, 3)]
    + [(k, "I", "i", NEGATED, k - 1) for k in (1, 2, 3)] + [(k, "T", "t", NEGATED, k - 1) for k in (1, 2, 3)])
REPORT = machine(
    ["own"], ["own", "said", "own, quoted", "said, quoted"],
    [("own", "ITitYNO", None, 1.0, "own"), ("own", "R", None, 1.0, "said"), ("own", "Q", None, 1.0, "own, quoted"),
     ("said", "ITitYNRO", None, REPORTED, "said"), ("said", "Q", None, 1.0, "said, quoted"),
     ("own, quoted", "ITitYNO", None, REPORTED, "own, quoted"), ("own, quoted", "R", None, 1.0, "said, quoted"),
     ("own, quoted", "Q", None, 1.0, "own"),
     ("said, quoted", "ITitYNRO", None, REPORTED, "said, quoted"), ("said, quoted", "Q", None, 1.0, "said")])
INSULT = machine([0], [0], [(0, "IiTtYNRQO", None, 1.0, 0)])
TARGET = machine(
    ["none", "to come"], ["none", "seen"],
    [("none", "IiTtNRQO", None, 1.0, "none")]
    + [(s, "Ii", None, TARGETED, s) for s in ("to come", "seen")]
    + [(s, "TtNRQO", None, 1.0, s) for s in ("to come", "seen")]
    + [(s, "Y", None, 1.0, "seen") for s in ("to come", "seen")])
THREATENED = machine(
    [0], [0],
    [(0, "IiYNRQO", None, 1.0, 0), (0, "Tt", None, 0.0, 0), (0, "Tt", None, 1.0, 4)]
    + [(k, "Y", None, 1.0, 0) for k in (4, 3, 2, 1)] + [(k, "Q", None, 1.0, k) for k in (4, 3, 2, 1)]
    + [(k, "IiNRO", None, 1.0, k - 1) for k in (4, 3, 2)] + [(k, "Tt", None, 0.0, k - 1) for k in (4, 3, 2)])
PARTS = (NEGATION, REPORT, INSULT, TARGET, THREATENED)
CLAUSE = reduce(compose, PARTS)


def clause_weight(symbols: list[tuple[str, float]]) -> float:
    """Weight of one clause: (symbol, weight) pairs, symbols I, T, Y, N, R, Q or O.

    Q is a quotation mark: it turns reporting on or off.  Of several threats that wait for
    one person the strongest counts.
    """
    return CLAUSE.best(symbols) or 0.0


class Grammar:
    """The transducers with a learned lexicon: entries (text, is_stem, weight)."""

    def __init__(self, lexicon: tuple[tuple[str, bool, float], ...]):
        self.words = {w: x for w, stem, x in lexicon if not stem}
        self.stems = {w: x for w, stem, x in lexicon if stem}
        self.lengths = sorted({len(w) for w in self.stems})
        self.anchors = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *THREATS}:
            self.anchors.add_word(w, len(w))
        if len(self.anchors):
            self.anchors.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        weight = self.words.get(word, 0.0)
        for n in self.lengths:
            if len(word) > n:
                weight = max(weight, self.stems.get(word[:n], 0.0))
        if weight:
            return "I", weight
        plain = word.replace("'", "").replace("’", "")
        for symbol, words in (("T", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
            if plain in words:
                return symbol, THREAT if symbol == "T" else 0.0
        return "O", 0.0

    def clauses(self, low: str) -> Iterator[tuple[int, int]]:
        """Bounds of the clauses that hold a match, each once, in order."""
        done = 0
        if not len(self.anchors):
            return
        for last, n in self.anchors.iter(low):
            at = last - n + 1
            if at < done or at and low[at - 1].isalnum():
                continue
            left = max(done, at - REACH)
            start = max((m.end() for m in _END.finditer(low, left, at)), default=left)
            stop = _END.search(low, last + 1, last + 1 + REACH)
            done = stop.start() if stop else min(len(low), last + 1 + REACH)
            if not stop and done < len(low):       # do not cut a word in two
                while done < len(low) and low[done].isalnum():
                    done += 1
            yield start, done

    def log_odds(self, text: str | None) -> float:
        low = (text or "").lower()
        best = stretch = 0.0
        end = 0
        for start, stop in self.clauses(low):
            symbols = []
            for token in re.finditer(r"[\"“”«»]|" + _WORD.pattern, low[start:stop]):
                word = token.group()
                symbols.append(("Q", 0.0) if word in "\"“”«»" else self.symbol(word))
            stretch = max(0.0, stretch - PER_CHARACTER * (start - end))
            stretch += clause_weight(symbols) - PER_CHARACTER * (stop - start)
            best, end = max(best, stretch), stop
        return BASE + best - math.log1p(len(low) / CHANCE)

    def score(self, text: str | None) -> float:
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(self.log_odds(text), 50.0))))


@lru_cache(maxsize=4)
def _grammar(lexicon: tuple) -> Grammar:
    return Grammar(lexicon)


# --- learning ---------------------------------------------------------------------

def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, text, toxic`` of about ``rows`` labelled rows outside the held-out quarter.

    The sample takes rows by a hash of their id; rows without id, text or label, and
    ids with contradicting labels, are left out.
    """
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .where(~held_out()).groupBy("doc_id")
              .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
              .where("toxic = most").select("doc_id", "toxic"))
    share = min(1.0, rows / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return (docs.select("doc_id", "text").where("text is not null").join(chosen, "doc_id")
            .select("doc_id", "text", "toxic"))


def _entries(word: Column) -> list[Column]:
    """The lexicon entries that a word could be covered by: itself and its stems (``stem*``)."""
    return [word] + [F.when(F.length(word) > n, F.concat(F.left(word, F.lit(n)), F.lit("*")))
                     for n in STEM_LENGTHS]


def learn(training: DataFrame, size: int = LEXICON_SIZE) -> tuple[tuple[str, bool, float], ...]:
    """A lexicon of at most ``size`` entries, strongest first; empty without toxic rows.

    ``training`` has doc_id, text, toxic.  In toxic texts a word counts for the first
    document that has it after the same neighbour; in clean ones for every document.
    """
    words = training.select("doc_id", "toxic", F.filter(
        F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("w"))
    pairs = (words.where("toxic = 1")
             .select("doc_id", F.explode_outer(F.arrays_zip(
                 F.col("w").alias("word"),
                 F.concat(F.array(F.lit("")), F.col("w")).alias("before"))).alias("p"))
             .where("p.word is not null")
             .groupBy("p.word", "p.before").agg(F.min("doc_id").alias("doc"))
             .groupBy("word", "doc").agg(F.count("*").alias("pairs")))
    toxic = (pairs.select("word", "doc", "pairs", F.explode_outer(F.array(*_entries(F.col("word")))).alias("e"))
             .where("e is not null").groupBy("e", "doc")
             .agg(F.sum("pairs").alias("pairs"), F.count("*").alias("words"))
             .groupBy("e").agg(F.count("*").alias("hits"), F.sum("pairs").alias("pairs"), F.max("words").alias("words"))
             .withColumn("stem", F.endswith("e", F.lit("*")))
             .where((F.col("hits") >= MIN_DOCS) & (F.col("hits") + F.col("pairs") >= 2 * MIN_EVIDENCE)
                    & (~F.col("stem") | (F.col("words") >= MIN_STEM_WORDS))))
    clean = (words.where("toxic = 0").select(F.array_distinct("w").alias("w"))
             .select(F.array_distinct(F.flatten(F.transform("w", lambda w: F.array(*_entries(w))))).alias("e"))
             .select(F.explode_outer("e").alias("e")).where("e is not null")
             .groupBy("e").agg(F.count("*").alias("clean")))
    counted = (toxic.join(clean, "e", "left").withColumn("entry", F.rtrim("e", F.lit("*")))
               .withColumn("clean", F.coalesce("clean", F.lit(0))))
    prior = training.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    if not prior["toxic"]:
        return ()
    base = math.log((prior["toxic"] + 1) / (prior["n"] - prior["toxic"] + 1))
    rows = (counted.select("entry", "stem", (F.log((F.col("hits") + 0.5) / (F.col("clean") + CLEAN_PRIOR)) - base).alias("w"))
            .where(F.col("w") >= MIN_LOG_ODDS)
            .orderBy(F.desc("w"), "entry", "stem").limit(size).collect())
    return tuple((r["entry"], r["stem"], float(min(r["w"], 8.0))) for r in rows)


# --- scoring ----------------------------------------------------------------------

def scored(docs: DataFrame, lexicon: tuple, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; existing columns of these names are replaced.

    A null or empty text gets the base score.  Rows are scored one by one, so repeated
    rows, ties and null ids make no difference.
    """
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        grammar = _grammar(lexicon)
        return pd.Series([grammar.score(t) for t in texts], dtype="float64")

    return (docs.withColumn("score", score("text"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``; lexicon learned from
    labelled rows outside the held-out quarter (crc32 of the id as text, modulo 4, is 2).

    A null doc_id is not held out.  Without labels every text gets the base score.
    """
    lexicon = learn(training_rows(docs, labels, rows))
    return scored(docs.select("doc_id", "text"), lexicon).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns only."""
    lexicon = learn(training_rows(docs, labels, rows))
    marked = scored(docs.select(F.struct("*").alias("row"), "text"), lexicon)
    return marked.where("predicted = 0").select("row.*")
