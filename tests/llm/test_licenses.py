import math
import random

from sheetloom.llm.licenses import (
    BAND, COVERAGE, SHINGLE, TEMPLATES, WINDOW, align, fingerprints, notices, scan, sure_pairs, with_places, words,
)

SCHEMA = "doc_id long, text string"


def test_alignment_with_gaps():
    a = "one two three four five six".split()
    assert align(a, a, 3) == (6, 0, 5)
    assert align(a, "x one two NEW three four six y".split(), 3) == (5, 1, 6)
    assert align(a, [], 3)[0] == 0 and align([], a, 3)[0] == 0


def test_every_notice_is_found_with_its_span(spark):
    rows, want = [], set()
    for name, texts in TEMPLATES.items():
        for k, text in enumerate(texts):
            body = f"Some words before, é — and {text.upper() if k else text} and after."
            rows.append((len(rows), body))
            want.add((len(rows) - 1, name))
    rows += [(900, None), (901, ""), (902, "Nothing licensed here at all."), (903, "x " * 50_000 + TEMPLATES["MIT"][0])]
    found = scan(spark.createDataFrame([(*r, "z") for r in rows], SCHEMA + ", text_key string")).collect()
    assert {(r.doc_id, r.license_id) for r in found} >= want | {(903, "MIT")}
    assert not {r.doc_id for r in found} & {900, 901, 902}
    for r in found:
        if r.doc_id < 900 and r.coverage == 1.0:
            span = dict(rows)[r.doc_id][r.start_char:r.end_char].lower()
            assert span[:8] == TEMPLATES[r.license_id][r.variant].lower()[:8]


def test_edited_notice_and_overlap():
    text = "This work is hereby licensed under the new GNU General Public License, version 3."
    [(name, _, coverage, matched, a, b)] = notices(text, [("GPL-3.0", 0, 0)], TEMPLATES)
    assert name == "GPL-3.0" and matched == 12 and coverage == 1.0 and text[a:b] == text[:-1]
    both = notices(TEMPLATES["CC-BY-4.0"][1], [("CC-BY-4.0", 1, 0), ("CC-BY-NC-4.0", 1, 0)], TEMPLATES)
    assert [n[0] for n in both] == ["CC-BY-4.0"]


def test_winnowing_keeps_one_of_each_window(spark):
    text = " ".join(f"w{i % 17}" for i in range(120))
    rows = fingerprints(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t").collect()
    at = sorted(r["at"] for r in rows)
    assert at and max(b - a for a, b in zip(at, at[1:])) <= WINDOW and at[-1] >= 120 - SHINGLE - WINDOW + 1


def test_repeated_rows_null_ids_and_empty(spark):
    text = TEMPLATES["MIT"][0]
    found = scan(spark.createDataFrame([(None, text), (1, text), (1, text)], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.license_id) for r in found) == [(0, "MIT"), (1, "MIT")]
    assert scan(spark.createDataFrame([], SCHEMA)).count() == 0


def best_at_every_place(text):
    """(license, variant, coverage) of the templates that some word position covers."""
    doc = [w for w, _, _ in words(text)]
    out = set()
    for name, texts in TEMPLATES.items():
        for k, notice in enumerate(texts):
            template = [w for w, _, _ in words(notice)]
            best = 0
            for begin in range(-BAND, len(doc) + BAND):
                start = max(0, begin - BAND)
                shift = begin - start
                window = doc[start:begin + len(template) + BAND] if begin + len(template) + BAND > 0 else []
                best = max(best, align([""] * shift + template, window, BAND)[0])
            if best >= COVERAGE * len(template):
                out.add((name, k))
    return out


def edited(notice, rng):
    """A notice with as many words lost as it may lack, others put in, and Turkish capitals."""
    parts = notice.split()
    lacking = len(words(notice)) - math.ceil(COVERAGE * len(words(notice)) - 1e-9)
    for i in sorted(rng.sample(range(len(parts)), min(lacking, len(parts))), reverse=True):
        if rng.random() < 0.5:
            del parts[i]
        else:
            parts[i] = "changed"
    for _ in range(rng.choice([0, 1, 3])):
        parts.insert(rng.randrange(len(parts) + 1), "put")
    return " ".join(parts)


def test_edited_notices_equal_aligning_at_every_place(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for name, texts in TEMPLATES.items():
        for k, text in enumerate(texts):
            for n in range(4):
                before = "İstanbul'da BİR yazı İİİ " * rng.choice([0, 1, 4])
                rows.append((len(rows), before + edited(text, rng) + " and so on."))
    rows += [(len(rows), "Released under an MIT License."), (len(rows) + 1, "Released under MIT License."),
             (len(rows) + 2, "İ İ İ İ İ İ İ İ İ " + TEMPLATES["MIT"][1])]
    for doc_id, text in rows:
        want[doc_id] = best_at_every_place(text)
    places = {}
    for r in with_places(spark.createDataFrame(rows, SCHEMA), TEMPLATES).collect():
        places[r.doc_id] = {(p["license_id"], p["variant"]) for p in r.places}
    for doc_id, found in want.items():
        assert found <= places.get(doc_id, set()), rows[doc_id]     # no covered template goes without a place
    got = {}
    for r in scan(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.doc_id, set()).add((r.license_id, r.variant))
    for doc_id, found in want.items():
        assert got.get(doc_id, set()) <= found
        assert bool(got.get(doc_id)) == bool(found), rows[doc_id]   # of overlapping ones the best stays
    assert sum(map(bool, want.values())) > 50 and all(want[len(rows) - k] for k in (1, 2, 3))


def test_a_pair_survives_any_loss():
    for texts in TEMPLATES.values():
        for notice in texts:
            template = [w for w, _, _ in words(notice)]
            pairs = sure_pairs(template)
            lacking = len(template) - math.ceil(COVERAGE * len(template) - 1e-9)
            places = [i for i, _, _ in pairs]
            assert len(pairs) == lacking + 1 and all(b - a > 1 for a, b in zip(places, places[1:]))


def test_no_text_is_shuffled(spark):
    docs = spark.createDataFrame([(1, "x")], SCHEMA)
    assert "Exchange" not in with_places(docs, TEMPLATES)._jdf.queryExecution().executedPlan().toString()
