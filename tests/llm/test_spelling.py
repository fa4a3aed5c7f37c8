import random
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from sheetloom.llm.spelling import UPPER, PositionIndex, near_words, roots, variants

LOWER = str.maketrans(UPPER, UPPER.lower())
SCHEMA = "doc_id long, text string"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def best_near(words: dict) -> dict:
    out = {}
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        if near:
            best = min(near, key=lambda x: (-words[x], x))
            out[w] = (len(near), best, words[best])
    return out


def plain(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 6:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 5}
    near = best_near(words)
    form = {w: near[w][1] if w in near and near[w][2] >= 5 * n else None for w, n in words.items()}
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, near.get(w, (0,))[0], words[form[w]] if form[w] else None))
    return out


def random_words(rng, n, letters="abé", sizes=(6, 9)):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(n)}


@pytest.mark.parametrize("letters,sizes", [("ab", (6, 8)), ("abcé", (6, 7)), ("ab", (60, 68))])
def test_sets_equal_brute_force(letters, sizes):
    rng = random.Random(len(letters) + sizes[0])
    words = sorted(random_words(rng, 150, letters, sizes))
    words += [w[:3] + "x" + w[3:] for w in words[:20]] + [w[:-1] for w in words[20:40] if len(w) > 6]
    words = sorted(set(words))
    ns = {w: rng.randint(5, 9) for w in words}
    index = PositionIndex(list(ns.items()))
    expected = best_near(ns)
    for w in words:
        near = index.near(w)
        found = {index.words[k][0] for k in range(len(words)) if near >> k & 1}
        assert found == {x for x in words if one_edit(w, x)}
        if near:
            assert index.best(near) == expected[w][1:]


@pytest.mark.parametrize("chunk", [7, 16_384])
def test_near_words_equal_brute_force(spark, chunk):
    rng = random.Random(5)
    words = {w: rng.randint(5, 60) for w in random_words(rng, 160) | {"aaaaaa", "aaaaab", "baaaaa", "aaaaaaa"}}
    found = near_words(spark.createDataFrame(list(words.items()), "word string, n long"), chunk).collect()
    assert {r.word: (r.n_near, r.near, r.near_n) for r in found} == best_near(words)
    assert len(found) == len({r.word for r in found})


def made_rows():
    rng = random.Random(11)
    stems = ["language", "straße", "señores", "général", "colour", "color", "aaaaaaa", "Ébauche", "ébauche"]
    rows = []
    for d in range(120):
        words = [rng.choice(stems) for _ in range(60)]
        words = [w[:k] + w[k + 1:] if rng.random() < 0.03 else w for w in words for k in [rng.randrange(len(w))]]
        words = [w.upper() if rng.random() < 0.2 else w for w in words]
        rows.append((d, " ".join(words) + f" x{d}y, under_score don't"))
    long = "verylong" * 4000
    rows += [(None, "language " * 7), (3, None), (4, ""), (5, "123 !?")]
    rows += [(900, f"{long} " * 5 + f"{long}z " * 40), (7, "language language"), (7, "language language")]
    # a chain of forms
    rows += [(901, "chainaa " * 5 + "chainab " * 30 + "chainxb " * 200 + "chaixxb " * 1200)]
    return rows


def test_equals_brute_force(spark):
    rows = made_rows()
    found = variants(spark.createDataFrame(rows, SCHEMA)).collect()
    ours = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found]
    expected = plain(rows)
    assert set(ours) == expected and len(ours) == len(expected)
    assert ("chainaa", "chaixxb") in {(w, root) for w, _, root, *_ in ours}


def test_long_chains_and_none(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(21)]
    found = roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.word: r.root for r in found} == {f"w{i}": "w21" for i in range(21)}
    assert roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_empty_and_extra_columns(spark):
    assert variants(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, "letter " * 5, "x", 2)], "doc_id long, text string, word string, n int")
    assert [tuple(r) for r in variants(docs).collect()] == [tuple(x) for x in plain([(1, "letter " * 5)])]
    with pytest.raises(ValueError):
        variants(docs, min_chars=5)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), entry.queries()["op12_spelling_variants"],
                       entry.oracle_sql()["op12_spelling_variants"], sf) is None
