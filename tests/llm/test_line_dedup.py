import hashlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from sheetloom.llm import line_dedup
from sheetloom.llm.line_dedup import LineRuns, digest, without_repeated_lines

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans(line_dedup.UPPER, line_dedup.UPPER.lower())
SCHEMA = "doc_id long, text string"


def plain(rows):
    """doc_id, n_lines, n_dropped, kept text of each row, the slow way."""
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= 40:
                holders[key].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(BLANKS).translate(LOWER)
            ids = holders.get(key, ())
            top = max((i for i in ids if i is not None), default=None)
            if len(ids) < 5 or doc_id == top:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def made_rows():
    long = [f"line {i} " + "word " * 8 + "é\U0001f600" * (i % 3) for i in range(12)]
    rows = []
    for d in range(60):
        picked = [long[(d * k) % 12] for k in (1, 3, 5)] + [f"own line of {d}, which is long enough to count {d}"]
        text = "\n".join([*picked, "short", "", "  " + picked[0].upper() + "\t\r", picked[1]])
        rows.append((d, text))
    rows += [(7, long[0]), (59, long[1] + "\n" + long[1]), (60, None), (61, ""), (62, "\n\n"),
             (None, long[2] + "\nx"), (None, long[3]), (8, rows[8][1]), (8, rows[8][1])]
    exact = "a" * 39
    rows += [(100 + i, exact + "\n" + exact + "a\n " + exact) for i in range(6)]
    rows += [(200 + i, "only four documents hold this line of text, so it stays") for i in range(4)]
    return rows


def as_key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("batches", [1, 4])
def test_equals_brute_force(spark, batches):
    rows = made_rows()
    found = without_repeated_lines(spark.createDataFrame(rows, SCHEMA), batches).collect()
    ours = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in found), key=as_key)
    assert ours == sorted(plain(rows), key=as_key)


def test_every_run_holds_new_keys_only(spark, tmp_path):
    store = LineRuns(spark, str(tmp_path), fanout=3)
    seen, counts = set(), defaultdict(int)
    for batch in range(5):
        keys = [(batch, k, -k) for k in range(batch * 5, batch * 5 + 12)]
        fresh = {(r.h1, r.h2) for r in store.add(spark.createDataFrame(keys, "doc_id long, h1 long, h2 long")).collect()}
        mine = {(a, b) for _, a, b in keys}
        assert fresh == mine - seen
        seen |= mine
        for k in mine:
            counts[k] += 1
    assert [len(level) for level in store.levels] == [2, 1]
    held = [(r.h1, r.h2) for name in store.runs() for r in spark.table(name).collect()]
    assert len(held) == len(set(held)) == len(seen)
    assert {(r.h1, r.h2): r.docs for r in store.counts().collect()} == counts
    store.close()


def test_runs_are_not_shuffled_again(spark, tmp_path):
    store = LineRuns(spark, str(tmp_path))
    lines = spark.range(1000).selectExpr("id as doc_id", "id as h1", "id as h2")
    for _ in range(2):
        store.add(lines)
    a, b = [spark.table(n) for n in list(store.runs())[:2]]
    plan = a.join(b.hint("merge"), line_dedup.HASH, "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    store.close()


def test_columns_stay_and_clashes_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a\nb", 5, "x")], "doc_id long, text string, n_lines int, `odd.name` string")
    row = without_repeated_lines(docs).first().asDict()
    assert row == {"doc_id": 1, "text": "a\nb", "odd.name": "x", "kept_text": "a\nb", "n_lines": 2, "n_dropped": 0}


def test_empty_table_and_text_ids(spark):
    assert digest(spark.createDataFrame([], SCHEMA)).collect() == []
    line = "the very same line of forty code points or more"
    rows = digest(spark.createDataFrame([(f"d{i}", line) for i in range(5)], "doc_id string, text string")).collect()
    assert {r.doc_id for r in rows if r.n_dropped == 0} == {"d4"}


def test_very_long_text(spark):
    line = "a line that stands in every one of the documents here"
    text = "\n".join([line] * 50_000 + [f"line {i}" for i in range(50_000)])
    rows = digest(spark.createDataFrame([(i, text) for i in range(5)], SCHEMA).repartition(5)).collect()
    kept = hashlib.sha256("\n".join(f"line {i}" for i in range(50_000)).encode()).hexdigest()
    assert {(r.n_lines, r.n_dropped, r.kept_sha256 == kept) for r in rows if r.doc_id < 4} == {(100_000, 50_000, True)}
    assert [r.n_dropped for r in rows if r.doc_id == 4] == [0]


def test_only_built_in_functions(spark):
    plan = digest(spark.createDataFrame(made_rows(), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), entry.queries()["op11_line_dedup"], entry.oracle_sql()["op11_line_dedup"], sf) is None
