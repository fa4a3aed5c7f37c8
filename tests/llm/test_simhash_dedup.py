import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sheetloom.llm.components import components
from sheetloom.llm.simhash_dedup import counts_in_unary, fingerprint, keep_one, links, near_duplicates


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts(n, seed):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "é", "ÀB", "x y", "gamma\tdelta", "tau\n", "rho", "\x1c", "\xa0q"]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            parts = rows[rng.randrange(len(rows))][1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2])):
                parts[rng.randrange(len(parts))] = rng.choice(words)
        else:
            parts = [rng.choice(words) + str(rng.randrange(400)) for _ in range(rng.choice([0, 1, 2, 5, 60, 200]))]
        rows.append((i, " ".join(parts)))
    return rows


def brute(rows, fps):
    ids = [i for i, _ in rows]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_follow_the_definition():
    for _, text in texts(200, 1) + [(0, ""), (0, " \t\n"), (0, "a"), (0, "a b"), (0, "Ä A b C " * 3)]:
        assert fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)
    assert fingerprint(None) == 0
    long = " ".join(str(i % 977) for i in range(70_000))
    assert fingerprint(long) & (1 << 64) - 1 == plain_fingerprint(long)


def test_components_equal_brute_force(spark):
    rows = texts(400, 2)
    fps = [plain_fingerprint(t) for _, t in rows]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute(rows, fps)
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{fp:016x}" for (i, _), fp in zip(rows, fps)}


def test_no_link_within_three_bits_is_lost(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for fp in list(fps):
        for _ in range(8):
            fps.add(fp ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    fps = sorted(fps)
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(fps)]
    found = {tuple(sorted((r.u, r.v))) for r in links(spark.createDataFrame(signed, "rep long, fp long")).collect()}
    assert found == {(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 3}


def test_the_embedding_bounds_the_bit_distance(spark):
    rng = np.random.default_rng(4)
    rows = [(int(a), int(b)) for a, b in rng.integers(-2**63, 2**63, (200, 2))]
    df = spark.createDataFrame(rows, "a long, b long").select(
        "a", "b", F.bit_count(counts_in_unary(F.col("a")).bitwiseXOR(counts_in_unary(F.col("b")))).alias("d"))
    for r in df.collect():
        counts = [[(x >> s & 3).bit_count() for s in range(0, 64, 2)] for x in (r.a & 2**64 - 1, r.b & 2**64 - 1)]
        assert r.d == sum(abs(p - q) for p, q in zip(*counts)) <= ((r.a ^ r.b) & 2**64 - 1).bit_count()


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string, fp string, rep int"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(3, None, "x", 1), (2, "", "y", 2), (None, "a b c", "z", 3), (7, "a b c", "q", 4), (7, "a b c", "q", 4),
            (None, "only here", "w", 5)]
    found = near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 7), (2, 2), (3, 2), (7, 7), (7, 7)]
    kept = keep_one(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "fp", "rep"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 2, 7, 7]


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(5, 100), (9, 8), (8, 9), (4, 4), (None, 3)]
    star = [(1000, i) for i in range(1001, 1200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(path + star, "u long, v long")).collect()}
    assert got == {**{i: 5 for i in range(100, 161)}, 9: 8, **{i: 1000 for i in range(1001, 1200)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_text_of_its_own_stays_beside_a_copy(spark):
    copied = " ".join(f"word{i}" for i in range(60))
    rows = [(1, copied), (2, copied), (2, "nothing like the other text, whose id is the same"), (3, copied), (None, copied)]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, copied), (2, rows[2][1]), (0, copied)])
