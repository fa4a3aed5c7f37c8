import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from sheetloom.llm.packing import best_fit, packed, plan, programmed, solve
from sheetloom.llm.tokens import WordTokens, default_tokenizer

SCHEMA = "doc_id long, text string"


def check(rows, capacity):
    """Gapless, within the capacity, and every piece placed once."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_words_give_the_tokenizers_ids():
    tokenizer, tokens = Tokenizer.from_file(default_tokenizer()), WordTokens(default_tokenizer())
    texts = ["", " ", "Hello, World's 12 things", "é́ İ Σς ß ÀÉ", "a<|endoftext|>b <|startoftext|>",
             "x y z\u0085q\x1cr", "漢字 Ａ１² ½", "it's they'll I'm 'd 've", "_-=+", "\x00\x01 tab\tline\n" * 3]
    for text, ids in zip(texts, tokens.texts(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_text_in_slices(monkeypatch):
    import sheetloom.llm.tokens as module
    monkeypatch.setattr(module, "SLICE_CHARS", 50)
    tokenizer, tokens = Tokenizer.from_file(default_tokenizer()), WordTokens(default_tokenizer())
    texts = ["word " * 40, None, "no" * 90, "a b\nc", "thing's " * 30]
    got = [ids.tolist() for ids in tokens.texts(texts)]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_pieces_equal_direct_encoding(spark):
    rows = [(1, "the quick brown fox " * 40), (2, None), (3, ""), (3, ""), (None, "null id"), (4, "a b c d e f g")]
    df = spark.createDataFrame([(*r, 9, 9) for r in rows], SCHEMA + ", length int, offset int")
    found = packed(df, capacity=32).collect()
    tokenizer = Tokenizer.from_file(default_tokenizer())
    want = Counter()
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for k, i in enumerate(range(0, len(ids), 32)):
            part = ids[i:i + 32]
            want[doc_id, k, i, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    assert check(found, 32) >= -(-sum(r.length for r in found) // 32)


def test_kept_ids_and_empty_table(spark):
    r = packed(spark.createDataFrame([(1, "hello there")], SCHEMA), keep_ids=True).first()
    assert r.ids[-1] == 0 and len(r.ids) == r.length
    assert packed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_plan_is_near_the_lower_bound():
    rng = np.random.default_rng(1)
    for sizes in (rng.integers(1, 100, 5000), rng.integers(1, 30, 3000)):
        made = plan(Counter(int(n) for n in sizes), capacity=100, rounds=400)
        assert made.sequences <= 1.01 * sizes.sum() / 100 + 1
    assert plan({60: 999}, capacity=100).sequences == 999
    assert plan({50: 1000}, capacity=100).sequences == 500
    assert plan({}, capacity=100).sequences == 0


def test_the_program_covers_what_it_solves():
    counts = {30: 100, 70: 90, 45: 41, 9: 500}
    solution = solve(counts, capacity=100, rounds=2000)
    for n, k in counts.items():
        assert sum(held.get(n, 0) * x for held, x in solution) >= k - 1e-3
    assert all(sum(n * k for n, k in held.items()) <= 100 for held, _ in solution)


def test_the_program_places_all_but_a_sequence_a_length():
    rng = np.random.default_rng(2)
    sizes = Counter(int(n) for n in np.minimum(512, rng.lognormal(4, 1.2, 20_000) + 1))
    entries = []
    for times in (1, 100):
        counts = {n: k * times for n, k in sizes.items()}
        total = sum(n * k for n, k in counts.items())
        whole, left = programmed(counts, 512)
        assert sum(n * k for n, k in left.items()) <= 512 * len(counts)
        for n, k in counts.items():
            assert sum(dict(key).get(n, 0) * x for key, x in whole) + left.get(n, 0) == k
        made = plan(counts, 512)
        assert made.sequences <= 1.005 * total / 512 + 1
        entries.append(len(made.length))
        if times == 100:
            assert sum(n * k for n, k in left.items()) <= 0.02 * total
    assert entries[1] <= 1.5 * entries[0]


def test_best_fit_by_count_equals_best_fit_by_piece():
    rng = np.random.default_rng(3)
    for top in (100, 60, 20):
        left = Counter(int(n) for n in rng.integers(1, top, 800))
        rooms: list[int] = []
        for n in sorted(left.elements(), reverse=True):
            fitting = [r for r in rooms if r >= n]
            rooms.append((rooms.pop(rooms.index(min(fitting))) if fitting else 100) - n)
        kinds = best_fit(left, 100)
        assert Counter(rooms) == sum((Counter({100 - sum(n * k for n, k in held): x}) for held, x in kinds), Counter())
        assert sum((Counter({n: k * x for n, k in held}) for held, x in kinds), Counter()) == left


def test_query_places_every_document(spark):
    from sheetloom.llm.queries import QUERIES
    rows = QUERIES["op8_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    total = sum(r.length for r in rows)
    assert check(rows, 2048) <= -(-total // 2048) + 2
