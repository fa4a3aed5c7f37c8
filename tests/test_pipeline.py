"""Profiling, mapping and facts on hand-written grids."""

from datetime import date, datetime, time

import pytest
from pyspark.sql import functions as F

from grids import META_LABELS, cells_frame, standard_sheet
from sheetloom.operators import mapping, profile, responses
from sheetloom.operators.facts import data_rows
from sheetloom.operators.mapping import match_analyte, match_meta, slug
from sheetloom.operators.profile import row_facts
from sheetloom.plans import gold, reports
from sheetloom.plans.silver import clean
from sheetloom.sources.canonical import DEFAULT_NAMES, CanonicalNames, load_names

LABELS = ["Impurity-1", "TFMBA", "Impurity-1", "Peak-A"]
BOUNDS = {"TFMBA": ("Min", 99.0, 98.5)}
ROWS = [
    {1: 7, 2: datetime(2026, 3, 4), 3: time(8, 5), 4: "27:00.0", 5: "#1", 6: "HPLC", 7: " Stage ",
     8: "Solid", 10: "white powder", 11: " OK ", 12: 0.05, 13: 99.5, 14: " 0.2", 15: "-0.1"},
    {1: "total"},
    {1: 7, 2: "04/03/2026", 3: "??:??", 5: "NULL", 11: "fail", 12: True, 13: 90, 14: "n.d.", 15: 0.1},
    {1: 8.9, 5: "#2", 11: "maybe", 12: "?", 13: "", 15: 1},
]


@pytest.fixture(scope="module")
def result(spark):
    flat = {(1, 1): "Log", **{(3, c): n for c, n in enumerate(["S.No", "Date", "Note", "By", "Note"], 1)},
            (5, 1): 1, (5, 2): " x ", (5, 3): "NULL", (6, 2): "", (7, 1): 2, (7, 3): "kept", (7, 4): "A"}
    small = {(1, 1): "a", (2, 1): "b"}
    no_labels = {(1, 1): "RT", (1, 2): 1.0, (2, 1): "Specification", (5, 5): "x"}
    nothing = {(r, c): "a label of more than 24 characters" for r in (1, 2, 3) for c in (1, 2, 3, 4)}
    lost = {(1, c): "abc" for c in (1, 2, 3, 4)} | {(1, 13): "a label of more than 24 characters", (9, 1): 1}
    no_rt = {k: v for k, v in standard_sheet(LABELS, ROWS, BOUNDS).items() if k[0] != 5 or k[1] == 1}
    cells = cells_frame(spark, {
        ("a.xlsx", "std"): standard_sheet(LABELS, ROWS, BOUNDS),
        ("a.xlsx", "flat"): flat, ("b.xlsx", "small"): small, ("b.xlsx", "no labels"): no_labels,
        ("b.xlsx", "nothing"): nothing, ("b.xlsx", "lost"): lost, ("b.xlsx", "no rt"): no_rt,
        ("b.xlsx", "empty"): {}})
    return clean(cells)


def test_layouts_and_notes(result):
    got = {(r.workbook, r.sheet): (r.layout, r.notes) for r in result.profiles.collect()}
    assert got == {
        ("a.xlsx", "std"): ("quality_standard", []), ("a.xlsx", "flat"): ("misc_flat", []),
        ("b.xlsx", "small"): ("unknown", [profile.NOTE_SMALL]),
        ("b.xlsx", "no labels"): ("unknown", [profile.NOTE_NO_BAND]),
        ("b.xlsx", "nothing"): ("unknown", [profile.NOTE_NOTHING]),
        ("b.xlsx", "lost"): ("unknown", [profile.NOTE_FLAT_LOST]),
        ("b.xlsx", "no rt"): ("unknown", [profile.NOTE_NO_MEASURED]),
        ("b.xlsx", "empty"): ("unknown", [profile.NOTE_SMALL])}


def test_header_rows(result):
    std = result.profiles.where("sheet = 'std'").first()
    assert (std.process_label_row, std.field_label_row, std.rt_row, std.rrt_row, std.unit_row) == (3, 4, 5, 6, 7)
    assert (std.spec_bound_row, std.spec_value_row, std.internal_spec_row) == (9, 10, 11)
    assert (std.data_start_row, std.n_data_rows) == (13, 3)
    flat = result.profiles.where("sheet = 'flat'").first()
    assert (flat.field_label_row, flat.data_start_row, flat.n_data_rows, flat.rt_row) == (3, 5, 2, None)


def test_columns_and_mappings(result):
    got = {(r.sheet, r.column_index): (r.raw_label, r.role, r.canonical, round(r.confidence, 4))
           for r in result.mappings.collect()}
    assert got[("std", 1)] == ("Entry", "ignored", None, 0.0)
    assert got[("std", 11)][1:] == ("meta", "appearance_solution", 0.8222)
    assert got[("std", 12)] == ("Impurity-1", "analyte", "Impurity_1", 0.95)
    assert got[("std", 15)] == ("Peak-A", "analyte", "unknown_Peak_A", 0.3)
    assert got[("flat", 2)] == ("Date", "meta", "sample_date", 0.9)
    assert ("std", 9) not in got and len(got) == 10 + 4 + 5
    rationale = result.mappings.where("sheet = 'std' AND column_index = 11").first().rationale
    assert rationale.endswith("(coverage=0.70)")


def test_observations(result):
    rows = result.observations_keyed.orderBy("row", "column_index").collect()
    assert [(r.row, r.row_seq) for r in rows[::4]] == [(13, 7), (15, 7), (16, 8)]
    assert [r.value for r in rows] == [0.05, 99.5, 0.2, None, None, 90.0, None, 0.1, None, None, None, 1.0]
    assert [r["pass"] for r in rows] == [True, True, False, None, None, False, None, True, None, None,
                                         None, False]
    first = rows[0]
    assert (first.sample_date, first.sample_time, first.report_time) == (date(2026, 3, 4), "08:05:00", None)
    assert (first.stage, first.appearance, first.appearance_solution) == ("Stage", "White Powder", "OK")
    assert (first.unit, first.spec_max, first.spec_internal_max, first.rt) == ("%/w/w", 0.1, 0.08, 1.0)
    assert (rows[1].spec_min, rows[1].spec_max, rows[1].spec_internal_min) == (99.0, None, 98.5)
    assert rows[4].batch_no is None and rows[4].appearance_solution == "FAIL"
    assert [r.raw_value for r in rows[8:]] == ["?", "", None, "1"]


def test_issues(result):
    std = {(r.row, r.column, r.rule, r.severity, r.raw_value, r.repaired_value)
           for r in result.issues_keyed.where("sheet = 'std'").collect()}
    assert std == {
        (13, "report_time", "malformed_time", "warning", "27:00.0", None),
        (13, "stage", "whitespace", "info", " Stage ", "Stage"),
        (13, "appearance", "case_variant", "info", "white powder", "White Powder"),
        (13, "appearance_solution", "whitespace", "info", " OK ", "True"),
        (13, "Impurity-1", "whitespace", "info", " 0.2", "0.2"),
        (13, "Peak-A", "negative_value", "warning", "-0.1", None),
        (15, "sample_date", "non_standard_date", "info", "04/03/2026", "2026-03-04"),
        (15, "sample_time", "malformed_time", "warning", "??:??", None),
        (15, "batch_no", "null_sentinel", "info", "NULL", None),
        (15, "Impurity-1", "wrong_type", "info", "True", None),
        (15, "Impurity-1", "non_numeric", "warning", "n.d.", None),
        (16, "appearance_solution", "unrecognized_token", "info", "maybe", None),
        (16, "Impurity-1", "null_sentinel", "info", "?", None)}
    flat = {(r.row_seq, r.column, r.rule) for r in result.issues.where("sheet = 'flat'").collect()}
    assert flat == {(1, "Date", "whitespace"), (1, "Note", "null_sentinel")}
    notes = {r.note for r in result.issues.where("column = 'stage' OR column = 'Peak-A'").collect()}
    assert notes == {"raw label was 'Stage'", "analyte=unknown_Peak_A"}


def test_flat_rows(result):
    rows = {r.row_seq: r.fields for r in result.misc_rows.collect()}
    assert rows == {1: {"S.No": "1", "Date": "x", "Note": None, "By": None},
                    3: {"S.No": "2", "Date": None, "Note": None, "By": "A"}}
    wide = result.misc_wide()
    assert wide.columns == ["workbook", "sheet", "row_seq", "By", "Date", "Note", "S.No"]


def test_blocks_do_not_change_results(spark, result, monkeypatch):
    monkeypatch.setattr(profile, "ROWS_PER_BLOCK", 2)
    rows = [{1: i, 2: datetime(2026, 1, 1 + i % 28), 5: f"#{i}", 12: i / 100, 13: 99.0, 15: "?"}
            for i in range(1, 40)]
    flat = {(2, c): n for c, n in enumerate(["A", "B", "C", "D"], 1)}
    flat |= {(4 + i * 3, 2): f"v{i}" for i in range(20)}
    small = clean(cells_frame(spark, {("w.xlsx", "s"): standard_sheet(LABELS, rows),
                                      ("w.xlsx", "f"): flat}))
    assert small.observations.count() == 39 * 4
    assert small.issues.count() == 39
    assert [r.row_seq for r in small.misc_rows.orderBy("row_seq").collect()] == list(range(1, 60, 3))
    counts = {r.sheet: (r.data_start_row, r.n_data_rows) for r in small.profiles.collect()}
    assert counts == {"s": (13, 39), "f": (4, 20)}


def test_last_column_of_a_field_wins(spark):
    grid = standard_sheet(["Impurity"], [{1: 1, 5: "#1", 9: "R1"}, {1: 2, 5: "#2"}, {1: 3, 9: "?"}])
    grid[(4, 9)] = "batch number"
    got = clean(cells_frame(spark, {("w.xlsx", "s"): grid})).row_meta.orderBy("row").collect()
    assert [r.batch_no for r in got] == ["R1", None, None]


def test_blank_label_inside_band(spark):
    grid = standard_sheet(["Impurity", "TFMBA", "TFMBA Acid"], [{1: 1, 13: 0.5}])
    for row in (4, 5):
        del grid[(row, 13)]
    done = clean(cells_frame(spark, {("w.xlsx", "s"): grid}))
    middle = done.observations.where("analyte = 'col_13'").first()
    assert (middle.analyte_canonical, middle.rt, middle.value) == ("unknown_col_13", None, 0.5)


def test_label_matching(spark):
    meta = spark.createDataFrame([("Batch",), ("batch #",), ("Reported   AT",), ("Reviewer",)], "raw_label string")
    got = {r.raw_label: (r.canonical, r.confidence) for r in match_meta(meta).collect()}
    assert got == {"Batch": ("batch_no", 0.95), "batch #": ("batch_no", 0.95),
                   "Reported   AT": ("report_time", 0.95), "Reviewer": (None, 0.0)}
    analyte = spark.createDataFrame([("IMP_1",), ("Impurity",), ("Impurity-3",), ("x",)], "raw_label string")
    got = {r.raw_label: (r.canonical, r.confidence) for r in match_analyte(analyte).collect()}
    assert got == {"IMP_1": ("Impurity_1", 0.95), "Impurity": ("Impurity_generic", 0.95),
                   "Impurity-3": ("Impurity_generic", 0.7), "x": (None, 0.0)}
    assert analyte.select(slug(F.lit(" --Late-peak-1.7 ")).alias("s")).first().s == "unknown_Late_peak_1_7"


def matches(df, label="raw_label"):
    return {r[label]: (r.canonical, r.confidence, r.rationale) for r in df.collect()}


@pytest.mark.parametrize("match", [match_meta, match_analyte])
def test_index_of_aliases_equals_trying_each(spark, monkeypatch, match):
    import random
    rng = random.Random(2)

    def word(n):
        return "".join(rng.choice("ab -_c") for _ in range(n))

    aliases = {f"N{i}": [word(rng.randint(0, 9)) for _ in range(8)] for i in range(30)} | {"É": ["été", "a", ""]}
    names = CanonicalNames(aliases, aliases)
    labels = spark.createDataFrame(
        [(word(rng.randint(0, 14)),) for _ in range(300)] + [(a,) for a in aliases["N3"]]
        + [("",), (None,), ("a",), ("ab",), ("x été y",), ("ABC  a",)], "raw_label string").distinct()
    monkeypatch.setattr(mapping, "LITERAL_ALIASES", 10 ** 6)
    each = matches(match(labels, names))
    monkeypatch.setattr(mapping, "LITERAL_ALIASES", 0)
    assert matches(match(labels, names)) == each and len(each) > 200


def test_a_hundred_thousand_aliases(spark):
    names = CanonicalNames({f"field {i}": [f"alias number {i} of many", f"short {i:05d}"] for i in range(50_000)}, {})
    labels = spark.createDataFrame(
        [("Alias  number 777 of many",), ("the SHORT 00042 one",), ("number 49999 of",), ("nothing",)], "raw_label string")
    found = match_meta(labels, names)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = {r.raw_label: r.canonical for r in found.collect()}
    assert got == {"Alias  number 777 of many": "field 777", "the SHORT 00042 one": "field 42",
                   "number 49999 of": "field 49999", "nothing": None}


def test_names_from_file(spark, tmp_path):
    path = tmp_path / "names.yaml"
    path.write_text('{"synonyms": {"a": ["x y", "z"]}, "analytes": {"B": ["b"]}}')
    names = load_names(path)
    assert load_names(path, spark) == names
    assert [tuple(r) for r in names.frame(spark, names.synonyms).orderBy("ord").collect()] == [
        ("a", "x y", 0), ("a", "z", 1)]
    assert DEFAULT_NAMES.frame(spark, DEFAULT_NAMES.synonyms).count() == 30


REPLIES = {
    '[{"raw": "R", "col": 12, "role": "analyte", "canonical": "C", "confidence": 0.8}]':
        [("R", 12, "analyte", "C", 0.8, "")],
    '{"columns": [{"raw": "R", "col": "3", "canonical": null}]}': [("R", 3, "ignored", None, 0.5, "")],
    '[{"raw": "R", "col": 2.7, "role": null, "confidence": "0.25", "rationale": "why"}, 5, "x"]':
        [("R", 2, "ignored", None, 0.25, "why")],
    '[{"col": 1}, {"raw": "R"}, {"raw": "R", "col": "2.7"}, {"raw": "R", "col": null},'
    ' {"raw": "R", "col": 1, "confidence": null}, {"raw": "R", "col": 1, "confidence": "high"}]': [],
    '{"mappings": []}': [], '"words"': [], "[]": [],
    "not json": None, "null": None, "5": None, '{"columns": null}': None, None: None,
}


def test_replies(spark):
    df = spark.createDataFrame([("w", str(i), t) for i, t in enumerate(REPLIES)],
                               "workbook string, sheet string, response string")
    valid, fallback = responses.read_replies(df)
    fields = ["raw_label", "column_index", "role", "canonical", "confidence", "rationale"]
    got = {}
    for r in valid.collect():
        got.setdefault(int(r.sheet), []).append(tuple(r[f] for f in fields))
    fell = {int(r.sheet) for r in fallback.collect()}
    for i, (text, expected) in enumerate(REPLIES.items()):
        assert (i in fell) == (expected is None), text
        assert got.get(i, []) == (expected or []), text


def test_responder(spark, monkeypatch):
    def respond(requests):
        return ['[{"raw": "x", "col": 12, "role": "analyte", "canonical": "Seen", "confidence": 0.4},'
                '{"raw": "x", "col": 12, "role": "analyte", "canonical": "Last", "confidence": 0.6},'
                '{"raw": "id", "col": 5, "role": "meta", "canonical": "batch_no", "confidence": 1}]'
                if "Sheet: s\n" in r else None for r in requests]

    monkeypatch.delenv("MOCK_LLM", raising=False)
    cells = cells_frame(spark, {("w.xlsx", s): standard_sheet(["Impurity", "TFMBA"], [{1: 1, 5: "#1", 12: 0.2}])
                                for s in ("s", "t")})
    done = clean(cells, responder=respond)
    assert {(r.sheet, r.source) for r in done.mappings.collect()} == {("s", "llm"), ("t", "mock_synonyms")}
    seen = done.observations.where("sheet = 's'").collect()
    assert [(r.analyte, r.analyte_canonical, r.mapping_confidence, r.batch_no) for r in seen] == [
        ("Impurity", "Last", 0.6, "#1")]
    assert done.observations.where("sheet = 't'").count() == 2
    monkeypatch.setenv("MOCK_LLM", "true")
    assert clean(cells, responder=respond).mappings.where("source = 'llm'").count() == 0


def test_replies_outlive_a_run(spark, tmp_path, monkeypatch):
    monkeypatch.delenv("MOCK_LLM", raising=False)
    calls, folder = tmp_path / "calls", str(tmp_path / "replies")
    calls.mkdir()

    def respond(requests):
        import os
        import uuid
        out = []
        for r in requests:
            with open(os.path.join(str(calls), uuid.uuid4().hex), "w") as f:
                f.write(r)
            out.append(None if "Sheet: mute" in r else '[{"raw": "x", "col": 12, "role": "analyte", "canonical": "C"}]')
        return out

    def run(books, sheets):
        grids = {(w, s): standard_sheet(["Impurity", "TFMBA"], [{1: 1, 12: 0.2}]) for w in books for s in sheets}
        done = clean(cells_frame(spark, grids), responder=respond, replies=folder)
        return {(r.workbook, r.sheet, r.analyte_canonical) for r in done.observations.collect()}

    first = run(["a.xlsx", "b.xlsx"], ["s", "t"])
    assert first == {(w, s, "C") for w in ("a.xlsx", "b.xlsx") for s in ("s", "t")}
    assert len(list(calls.iterdir())) == 2              # one text a sheet name, whatever the workbook
    assert run(["a.xlsx", "b.xlsx"], ["s", "t"]) == first and len(list(calls.iterdir())) == 2
    # no reply: the aliases serve, and a later run asks again
    assert run(["c.xlsx"], ["s", "mute"]) == {
        ("c.xlsx", "s", "C"), ("c.xlsx", "mute", "Impurity_generic"), ("c.xlsx", "mute", "TFMBA")}
    assert len(list(calls.iterdir())) == 3
    requests = spark.createDataFrame([("c.xlsx", "mute", "Sheet: mute\n")], "workbook string, sheet string, request string")
    for n in (4, 5):
        assert responses.ask_once(requests, respond, folder).count() == 0 and len(list(calls.iterdir())) == n


def test_first_of_two_kept_replies_counts(spark, tmp_path):
    folder = str(tmp_path / "replies")
    assert responses.kept_replies(spark, folder).count() == 0
    spark.createDataFrame([("k", "late", datetime(2026, 1, 2)), ("k", "early", datetime(2026, 1, 1))],
                          responses.KEPT).write.parquet(folder)
    assert [tuple(r) for r in responses.kept_replies(spark, folder).collect()] == [("k", "early")]


def test_marts_and_reports(result):
    obs, issues, maps = result.observations_keyed, result.issues_keyed, result.mappings
    rate = {r.batch_no: (r.observations, r.passing, r.failing, r.pass_rate)
            for r in gold.mv_batch_pass_rate(obs).collect()}
    assert rate == {"#1": (3, 2, 1, 0.667), None: (2, 1, 1, 0.5), "#2": (1, 0, 1, 0.0)}
    batches = {r.batch_no: (r.stage, r.first_seen) for r in gold.dim_batch(obs).collect()}
    assert batches == {"#1": ("Stage", date(2026, 3, 4)), "#2": (None, None)}
    analytes = {r.analyte_canonical: r for r in gold.dim_analyte(obs).collect()}
    assert analytes["Impurity_1"].raw_label_variants == ["Impurity-1"]
    assert analytes["TFMBA"].avg_spec_max is None and analytes["TFMBA"].avg_spec_min == 99.0
    total = gold.compliance_summary(obs).first()
    assert tuple(total) == (12, 3, 3, 50.0)
    states = reports.compliance_three_state(obs).first()
    assert (states.pass_pct, states.fail_pct, states.na_count) == (25.0, 25.0, 6)
    assert reports.compliance_three_state(obs.limit(0)).first().pass_pct == 0.0
    reasons = gold.quarantine_review(maps, issues).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in reasons} == {"mapping_low_confidence": 1, "dq_warning": 4}
    assert reports.mapping_review_digest(maps).first().flagged == 1
    summary = {r.workbook: tuple(r)[1:] for r in reports.per_workbook_summary(
        result.profiles, obs, issues, maps).collect()}
    assert summary == {"a.xlsx": (12, 15, 19), "b.xlsx": (0, 0, 0)}
    manifest = reports.export_manifest(obs, issues, maps).collect()
    assert [(r.workbook, r.export_name) for r in manifest] == [("a.xlsx", "a_CLEAN.xlsx")]
    assert reports.unanswered_sheets(result.profiles, maps).count() == 0
    violations = gold.mv_spec_violations(obs).where("analyte_canonical = 'TFMBA'").first()
    assert (violations.violation_count, violations.avg_overshoot) == (1, None)


def test_meta_labels_are_complete(result):
    assert result.columns.where("sheet = 'std' AND kind = 'meta'").count() == len(META_LABELS)
    assert data_rows(result.planned).count() == 3


def test_profiling_reads_text_of_the_first_rows_only(spark, tmp_path):
    grid = standard_sheet(["TFMBA"], [{1: i + 1, 5: "#", 12: 1} for i in range(40)])
    cells_frame(spark, {("w.xlsx", "s"): grid}).write.parquet(str(tmp_path / "cells"))
    facts = row_facts(spark.read.parquet(str(tmp_path / "cells")))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    header = [line for line in scans if "LessThanOrEqual(row" in line]
    body = [line for line in scans if "GreaterThan(row" in line]
    assert header and body and all("raw:" not in line for line in body)
    assert facts.where("hrow > 27").count() == 1
