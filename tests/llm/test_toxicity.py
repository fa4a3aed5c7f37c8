import itertools
import math
import random
import zlib

import pytest

from sheetloom.llm.toxicity import (
    BASE, CLAUSE, PARTS, Grammar, clause_weight, toxicity, training_rows, without_toxic,
)

LEXICON = (("fool", False, 4.0), ("blagh", True, 4.0))


def test_transducers_compose():
    insult = [("I", 4.0)]
    plain = clause_weight(insult)
    assert clause_weight([("Y", 0), *insult]) > plain > clause_weight([("N", 0), *insult])
    assert clause_weight([("R", 0), *insult]) < plain
    assert clause_weight([("Q", 0), *insult, ("Q", 0)]) < plain == clause_weight([("Q", 0), ("Q", 0), *insult])
    assert clause_weight([("N", 0), *[("O", 0)] * 5, *insult]) == plain
    assert clause_weight([("T", 5.0)]) == 0 < clause_weight([("T", 5.0), ("Y", 0)])
    assert clause_weight([("T", 5.0), *[("O", 0)] * 6, ("Y", 0)]) == 0


def walks(parts, symbol, states):
    """Every way to pass one symbol through a chain of machines: (factor, next states)."""
    if not parts:
        yield 1.0, ()
        return
    for out, factor, target in parts[0].arcs[states[0]].get(symbol, ()):
        for rest, targets in walks(parts[1:], out, states[1:]):
            yield factor * rest, (target, *targets)


def best_walk(symbols):
    """Greatest weight over all paths through the parts, one after the other."""
    def go(i, states, total):
        if i == len(symbols):
            return [total] if all(s in p.finals for s, p in zip(states, PARTS)) else []
        return [w for factor, after in walks(PARTS, symbols[i][0], states)
                for w in go(i + 1, after, total + symbols[i][1] * factor)]

    return max((w for states in itertools.product(*[p.starts for p in PARTS]) for w in go(0, states, 0.0)), default=None)


def test_composition_equals_walking_all_paths():
    rng = random.Random(8)
    for n in range(300):
        symbols = [(c, rng.choice([1.0, 2.5, 4.0]) if c in "IT" else 0.0)
                   for c in rng.choices("ITYNRQO", k=rng.randint(0, 7))]
        assert CLAUSE.best(symbols) == pytest.approx(best_walk(symbols)), symbols
    # some path accepts every clause, so that a clause never fails
    assert all(CLAUSE.best([(c, 0.0) for c in word]) is not None for word in itertools.product("ITYNRQO", repeat=4))
    assert len(CLAUSE.arcs) > max(len(p.arcs) for p in PARTS)


def test_a_toxic_paragraph_in_a_long_clean_text():
    g = Grammar(LEXICON)
    passage = "you are a fool. you blaghter, you fool. they are not clever, you fool."
    clean = "the quiet river went on past the mill and the old house. " * 2000
    assert g.score(passage) > 0.9 and g.score(clean) < 0.05
    for before in (0, 30_000, 100_000):
        assert g.score(clean[:before] + passage + clean) > 0.9
    # matches far apart do not add up
    assert g.score(("fool. " + "quiet words follow. " * 700) * 20) < 0.3 < g.score("fool. fool. fool.")


def test_clauses_not_words():
    g = Grammar(LEXICON)
    assert g.log_odds("you fool") > g.log_odds("you are not a fool") > BASE
    assert g.log_odds("they said fool") < g.log_odds("a fool")
    assert g.log_odds("foolish tomfool") == pytest.approx(BASE, abs=0.02)
    assert g.log_odds("blaghxy") > 0 > g.log_odds("xblaghy")
    assert g.log_odds("FOOL. fool") > g.log_odds("fool")
    assert g.score(None) == g.score("") == pytest.approx(1 / (1 + math.exp(-BASE)))
    assert 0 <= g.score("fool " * 100_000) <= 1


def corpus(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(rng.randint(30, 90))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words[rng.randrange(len(words))] = rng.choice(["nasty", "zwib" + rng.choice("abcdefgh") * 2])
        rows.append((i, " ".join(words), "en", 0.5))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int"), rows, dict(labels))


def test_held_out_accuracy(spark):
    docs, labels, rows, truth = corpus(spark)
    found = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r.predicted == (r.score >= 0.3)
    held = [i for i, r in found.items() if r.held_out]
    assert sum(found[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.predicted}


def test_held_out_labels_are_not_read(spark):
    docs, labels, *_ = corpus(spark)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in training_rows(docs, labels).collect())
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) toxic")
    a, b = ({r.doc_id: r.score for r in toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "x"), (1, None), (1, None), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id long, toxic int")
    base = 1 / (1 + math.exp(-BASE))
    assert all(r.score == pytest.approx(base, abs=1e-4) for r in toxicity(docs, labels).collect())
    assert toxicity(docs, labels).count() == 4
    assert toxicity(docs.limit(0), labels.limit(0)).count() == 0
