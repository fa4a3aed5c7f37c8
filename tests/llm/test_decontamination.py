import random
import re
from collections import Counter

from sheetloom.llm.decontamination import clean, contaminated

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def best(doc, item):
    d, q = words(doc), words(item)
    k = min(5, len(q))
    if not q or len(d) < k:
        return 0.0
    want = Counter(tuple(q[i:i + k]) for i in range(len(q) - k + 1))
    grams = [tuple(d[i:i + k]) for i in range(len(d) - k + 1)]
    size, top = sum(want.values()), 0.0
    for s in range(max(1, len(grams) - size + 1)):
        got = Counter(grams[s:s + size])
        shared = sum((got & want).values())
        top = max(top, shared / (sum(got.values()) + size - shared))
    return top


def made(seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([14, 20, 40, 59, 80])))) for i in range(25)]
    items += [(100, "the cat sat"), (101, ""), (102, None), (103, "Same, words; here again now."),
              (104, "same words here again now"), (105, "go go go go go go go go stop")]
    docs = []
    for i in range(120):
        body = rng.choices(pool, k=rng.randint(0, 150))
        item = words(rng.choice(items)[1])
        for _ in range(rng.choice([0, 0, 1, 2])):
            if item:
                at = rng.randrange(len(item))
                item[at:at + rng.randint(0, 1)] = [rng.choice(pool)] * rng.randint(0, 1)
        at = rng.randint(0, len(body))
        body[at:at] = [w.upper() if rng.random() < 0.3 else w for w in item]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(body)))
    return docs + [(500, None), (501, ""), (502, "the cat sat"), (503, "go " * 30)], items


def test_equals_brute_force(spark):
    docs, items = made(1)
    found = contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found}
    want = {(d, i): round(best(t, q), 9) for d, t in docs for i, q in items if best(t, q) >= 0.8}
    assert got == want and len(found) == len(got) and len(want) > 50
    for r in found:
        d, q = words(dict(docs)[r.doc_id]), words(dict(items)[r.item_id])
        assert best(" ".join(d[r.start_word:r.start_word + r.n_words]), " ".join(q)) >= 0.8


def test_documents_shorter_than_the_item_equal_brute_force(spark):
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(pool, k=k))) for i, k in enumerate((14, 20, 40, 49, 59, 80, 200))]
    docs = [(0, " ".join(words(items[3][1])[:41]))]
    for i in range(1, 150):
        item = words(rng.choice(items)[1])
        gone = rng.randint(0, len(item) // 4)
        front = rng.randint(0, gone)
        part = item[front:len(item) - (gone - front)]
        if rng.random() < 0.3:
            part[rng.choice([0, -1, len(part) // 2])] = rng.choice(pool)
        docs.append((i, " ".join(part)))
    docs = spark.createDataFrame(docs, DOCS), docs
    items = spark.createDataFrame(items, ITEMS), items
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in contaminated(docs[0], items[0]).collect()}
    want = {(d, i): round(best(t, q), 9) for d, t in docs[1] for i, q in items[1] if best(t, q) >= 0.8}
    assert got == want and (0, 3) in got and 40 < len(want) < 150
    kept = {r.doc_id for r in clean(docs[0], items[0]).collect()}
    assert kept == {d for d, _ in docs[1]} - {d for d, _ in want}


def test_clean_and_odd_rows(spark):
    item = "one two three four five six seven eight"
    docs = spark.createDataFrame(
        [(1, item, 0.5), (1, item, 0.5), (2, "quite another text", 0.1), (None, item, 0.2), (3, None, None),
         (4, "x " * 60_000 + item, 1.0)], DOCS + ", similarity double")
    items = spark.createDataFrame([(7, item, 1), (7, item, 1), (8, item, 2)], ITEMS + ", size int")
    found = sorted((r.doc_id or 0, r.item_id) for r in contaminated(docs, items).collect())
    assert found == [(0, 7), (0, 8), (1, 7), (1, 8), (4, 7), (4, 8)]
    kept = clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_rows_are_judged_by_their_own_text(spark):
    item, other = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen"
    items = spark.createDataFrame([(None, item), (5, other), (5, "quite different words that make another passage")], ITEMS)
    docs = spark.createDataFrame([(1, item), (1, "a clean text of the same id"), (2, "x " + other), (None, "clean too"),
                                  (3, "so quite different words that make another passage here")], DOCS)
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert found == {(1, None), (2, 5), (3, 5)}
    assert {(r.doc_id, r.text) for r in clean(docs, items).collect()} == {
        (1, "a clean text of the same id"), (None, "clean too")}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], DOCS), spark.createDataFrame([(1, "a b c")], ITEMS)
    none = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert contaminated(none[0], items).count() == 0
    assert contaminated(docs, none[1]).count() == 0
    assert clean(docs, none[1]).count() == 1
