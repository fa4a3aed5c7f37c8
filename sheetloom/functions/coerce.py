"""Value coercion: every function yields struct<value, rule>.

``rule`` names the repair or rejection that fired, or is null.  Each text
function may have a ``*_cell`` twin that honours the type a spreadsheet cell had.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.contracts import META_TYPES
from sheetloom.functions.text import FLOAT_TEXT, collapse, double_text, strip

# Fixed values, in the order in which they are tried where order matters.
NULL_SENTINELS = ["null", "?", "n/a", "na", "--", "-", "none"]
PASS_TOKENS = ["ok", "pass", "passed", "yes", "y", "true", "complies", "complied"]
FAIL_TOKENS = ["fail", "failed", "no", "n", "false", "out of spec", "oos"]

# A text is parsed by the first pattern whose shape it has; no text that fails
# there would parse by a later one.  The shapes keep to strptime's widths (two
# digits for a day, or a blank and one; four for a year).
_D = r"(3[01]|[12]\d|0?[1-9]| [1-9])"
_M = r"(1[0-2]|0?[1-9])"
_Y = r"(?!0000)\d{4}"
_MON = r"[A-Za-z]{3}"
_MONTH = r"[A-Za-z]{3,9}"
DATE_FORMATS = [
    ("yyyy-M-d", f"^{_Y}-{_M}-{_D}$"),
    ("yyyy/M/d", f"^{_Y}/{_M}/{_D}$"),
    ("d/M/yyyy", f"^{_D}/{_M}/{_Y}$"),
    ("d-M-yyyy", f"^{_D}-{_M}-{_Y}$"),
    ("M/d/yyyy", f"^{_M}/{_D}/{_Y}$"),
    ("M-d-yyyy", f"^{_M}-{_D}-{_Y}$"),
    ("MMM d yyyy", f"^{_MON} {_D} {_Y}$"),
    ("d MMM yyyy", f"^{_D} {_MON} {_Y}$"),
    ("MMMM d yyyy", f"^{_MONTH} {_D} {_Y}$"),
    ("d MMMM yyyy", f"^{_D} {_MONTH} {_Y}$"),
    ("d-MMM-yyyy", f"^{_D}-{_MON}-{_Y}$"),
    ("d-MMMM-yyyy", f"^{_D}-{_MONTH}-{_Y}$"),
]
STANDARD_DATE = f"^{_Y}[-/]"     # year first: needs no repair note

_H24 = r"(2[0-3]|[01]?\d)"
_H12 = r"(1[0-2]|0?[1-9])"
_60 = r"[0-5]?\d"
TIME_FORMATS = [
    ("H:m:s", f"^{_H24}:{_60}:{_60}$"),
    ("H:m", f"^{_H24}:{_60}$"),
    ("h:m a", f"(?i)^{_H12}:{_60} [ap]m$"),
    ("h:m:s a", f"(?i)^{_H12}:{_60}:{_60} [ap]m$"),
]


@dataclass
class Text:
    """A text with its usual forms and readings.

    ``of`` spells everything out inside one expression.  On hot paths the parts are
    columns made by :func:`with_texts`, so that each is computed once per row and
    the code generated for a row stays small enough to be compiled.
    """

    raw: Column
    stripped: Column
    lowered: Column
    flat: Column              # inner whitespace collapsed
    date: Column | None = None
    time: Column | None = None
    number: Column | None = None
    titled: Column | None = None

    @classmethod
    def of(cls, raw: Column) -> Text:
        s = strip(raw)
        flat = collapse(s)
        return cls(raw, s, F.lower(s), flat,
                   **{name: read(s, flat) for name, read in READINGS.items()})

    @classmethod
    def column(cls, raw: Column, name: str) -> Text:
        return cls(raw, *[F.col(f"{name}_{part}") for part in ("stripped", "lowered", "flat")],
                   **{reading: F.col(f"{name}_{reading}") for reading in READINGS})

    @property
    def blank(self) -> Column:
        return self.raw.isNull() | (self.stripped == "")

    @property
    def sentinel(self) -> Column:
        return self.lowered.isin(NULL_SENTINELS)


def with_texts(df: DataFrame, texts: dict[str, tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Add the columns that :meth:`Text.column` refers to.

    ``texts`` gives for each name the raw text and the readings that are wanted of
    it, each with the condition under which it is.
    """
    stripped = df.withColumns({f"{n}_stripped": strip(raw) for n, (raw, _) in texts.items()})
    # blanks are collapsed only for what reads the collapsed text
    reads_flat = {n: [wanted for reading, wanted in readings.items() if reading in FLAT_READINGS]
                  for n, (_, readings) in texts.items()}
    formed = stripped.withColumns({
        **{f"{n}_lowered": F.lower(f"{n}_stripped") for n in texts},
        **{f"{n}_flat": F.when(reduce(lambda a, b: a | b, wanted), collapse(F.col(f"{n}_stripped")))
           if wanted else F.lit(None).cast("string") for n, wanted in reads_flat.items()}})
    return formed.withColumns({
        f"{n}_{reading}": F.when(wanted, READINGS[reading](F.col(f"{n}_stripped"),
                                                           F.col(f"{n}_flat")))
        for n, (_, readings) in texts.items() for reading, wanted in readings.items()})


def _text(value: Column | Text) -> Text:
    return value if isinstance(value, Text) else Text.of(value)


def _result(value: Column, rule: Column) -> Column:
    return F.named_struct(F.lit("value"), value, F.lit("rule"), rule)


def _no_rule() -> Column:
    return F.lit(None).cast("string")


def _parse(flat: Column, formats: list[tuple[str, str]]) -> Column:
    pattern = None
    for form, shape in formats:
        hit = flat.rlike(shape)
        pattern = F.when(hit, form) if pattern is None else pattern.when(hit, form)
    # a blank that stands for a day's first digit is no part of the pattern
    return F.try_to_timestamp(F.regexp_replace(flat, "([-/]) (?=[1-9])", "$1"), pattern)


def _read_number(stripped: Column, flat: Column) -> Column:
    return F.when(stripped.rlike(FLOAT_TEXT),
                  F.replace(stripped, F.lit("_"), F.lit("")).try_cast("double"))


def _read_title(stripped: Column, flat: Column) -> Column:
    """Words in one case capitalised, words in mixed case kept."""
    def recase(word: Column) -> Column:
        one_case = (word == F.lower(word)) | (word == F.upper(word))
        return F.when(one_case, F.concat(F.upper(F.substring(word, 1, 1)),
                                         F.lower(F.substr(word, F.lit(2))))).otherwise(word)

    return F.array_join(F.transform(F.split(flat, " "), recase), " ")


READINGS = {
    "date": lambda stripped, flat: _parse(flat, DATE_FORMATS).cast("date"),
    "time": lambda stripped, flat: F.date_format(_parse(flat, TIME_FORMATS), "HH:mm:ss"),
    "number": _read_number,
    "titled": _read_title,
}
FLAT_READINGS = ("date", "time", "titled")      # those made of the collapsed text


def coerce_str(text: Column | Text) -> Column:
    t = _text(text)
    value = F.when((t.stripped != "") & ~t.sentinel, t.stripped)
    rule = (F.when(t.blank, _no_rule()).when(t.sentinel, "null_sentinel")
            .when(t.stripped != t.raw, "whitespace"))
    return _result(value, rule)


def coerce_appearance(text: Column | Text) -> Column:
    t = _text(text)
    value = F.when((t.stripped != "") & ~t.sentinel, t.titled)
    rule = (F.when(t.blank, _no_rule()).when(t.sentinel, "null_sentinel")
            .when(t.stripped != t.raw, "whitespace")
            .when(t.titled != t.stripped, "case_variant"))
    return _result(value, rule)


def coerce_pass_fail(text: Column | Text) -> Column:
    t = _text(text)
    value = F.when(t.lowered.isin(PASS_TOKENS), True).when(t.lowered.isin(FAIL_TOKENS), False)
    rule = (F.when(t.blank, _no_rule()).when(t.sentinel, "null_sentinel")
            .when(~t.lowered.isin(PASS_TOKENS + FAIL_TOKENS), "unrecognized_token")
            .when(t.stripped != t.raw, "whitespace"))
    return _result(value, rule)


def coerce_date(text: Column | Text) -> Column:
    t = _text(text)
    rule = (F.when(t.blank, _no_rule()).when(t.sentinel, "null_sentinel")
            .when(t.date.isNull(), "malformed_date")
            .when(~t.flat.rlike(STANDARD_DATE), "non_standard_date"))
    return _result(t.date, rule)


def coerce_time(text: Column | Text) -> Column:
    t = _text(text)
    rule = F.when((t.stripped != "") & t.time.isNull(), "malformed_time")
    return _result(t.time, rule)


def coerce_float(text: Column | Text) -> Column:
    t = _text(text)
    number = t.number
    # NaN sorts above every number here, so it is never below zero, as in Python.
    value = F.when(number >= 0, number)
    rule = (F.when(t.blank, _no_rule()).when(t.sentinel, "null_sentinel")
            .when(number.isNull(), "non_numeric").when(number < 0, "negative_value")
            .when(t.stripped != t.raw, "whitespace"))
    return _result(value, rule)


# --- twins over cell structs -------------------------------------------------

def coerce_date_cell(cell: Column, text: Text | None = None) -> Column:
    native = cell["kind"].isin("d", "dt")
    parsed = coerce_date(text or cell["raw"])
    return _result(F.when(native, cell["dt"].cast("date")).otherwise(parsed["value"]),
                   F.when(native, _no_rule()).otherwise(parsed["rule"]))


def coerce_time_cell(cell: Column, text: Text | None = None) -> Column:
    clock = F.regexp_replace(F.date_format(cell["dt"], "HH:mm:ss.SSSSSS"), r"\.000000$", "")
    parsed = coerce_time(text or cell["raw"])
    return _result(
        F.when(cell["kind"] == "t", cell["tm"]).when(cell["kind"] == "dt", clock)
        .otherwise(parsed["value"]),
        F.when(cell["kind"].isin("t", "dt"), _no_rule()).otherwise(parsed["rule"]))


def coerce_float_cell(cell: Column, text: Text | None = None) -> Column:
    kind, num = cell["kind"], cell["num"]
    parsed = coerce_float(text or cell["raw"])
    return _result(
        F.when(kind == "n", F.when(num >= 0, num)).when(kind == "b", F.lit(None).cast("double"))
        .otherwise(parsed["value"]),
        F.when(kind == "b", "wrong_type").when(kind == "n", F.when(num < 0, "negative_value"))
        .otherwise(parsed["rule"]))


def _as_text(coercion):
    return lambda cell, text=None: coercion(text or cell["raw"])


# Which coercion a canonical row-level field gets (fixed values); any other
# name, as a model may propose, is plain text.
META_COERCIONS = {
    "sample_date": coerce_date_cell,
    "sample_time": coerce_time_cell,
    "report_time": coerce_time_cell,
    "batch_no": _as_text(coerce_str),
    "instrument_id": _as_text(coerce_str),
    "stage": _as_text(coerce_str),
    "sample_form": _as_text(coerce_str),
    "appearance": _as_text(coerce_appearance),
    "appearance_solution": _as_text(coerce_pass_fail),
}


def by_family(canonical: Column, outcome) -> Column:
    """``outcome`` of the coercion that a canonical name calls for."""
    families = [
        (["sample_date"], coerce_date_cell),
        (["sample_time", "report_time"], coerce_time_cell),
        (["appearance"], META_COERCIONS["appearance"]),
        (["appearance_solution"], META_COERCIONS["appearance_solution"]),
    ]
    chosen = None
    for names, coercion in families:
        hit = canonical.isin(names)
        value = outcome(coercion)
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return chosen.otherwise(outcome(_as_text(coerce_str)))


def audit_text(value: Column, coercion) -> Column:
    """A coerced value as the quality log shows it."""
    if coercion is META_COERCIONS["appearance_solution"]:
        return F.when(value, "True").when(~value, "False")
    return value.cast("string")


# --- verdicts and small composites ---------------------------------------------

def evaluate_pass(value: Column, spec_min: Column, spec_max: Column) -> Column:
    """Three-valued specification verdict; bounds are inclusive.

    A NaN measurement compares false with any bound, hence passes.
    """
    is_nan = F.isnan(value)
    return (F.when(value.isNull(), F.lit(None).cast("boolean"))
            .when(spec_min.isNotNull() & ~is_nan & (value < spec_min), False)
            .when(spec_max.isNotNull() & ~is_nan & (value > spec_max), False)
            .when(spec_min.isNull() & spec_max.isNull(), F.lit(None).cast("boolean"))
            .otherwise(True))


def spec_limits(bound: Column, spec: Column, internal: Column) -> dict[str, Column]:
    """Which side each limit constrains: 'Min…' is a floor, all else a ceiling."""
    floor = F.coalesce(F.lower(bound).startswith("min"), F.lit(False))
    return {
        "spec_min": F.when(floor, spec),
        "spec_max": F.when(~floor, spec),
        "spec_internal_min": F.when(floor, internal),
        "spec_internal_max": F.when(~floor, internal),
    }


def compose_unit(unit: Column, sub_unit: Column) -> Column:
    slash = F.when(sub_unit != "", F.concat(F.lit("/"), sub_unit))
    return F.nullif(F.concat(F.coalesce(unit, F.lit("")), F.coalesce(slash, F.lit(""))), F.lit(""))


def small(rule, value: Column) -> Column:
    """A long expression within a lambda, which keeps it out of the code of the stage: a
    method beyond 8,000 bytes is run by the JVM's interpreter for good."""
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def clarity_text(flag: Column) -> Column:
    return F.when(flag, "OK").when(~flag, "FAIL")


def serialize(value: Column, data_type: str) -> Column:
    """Text of a value in an exported file; null is empty."""
    if data_type == "boolean":
        text = value.cast("string")
    elif data_type in ("double", "float"):
        text = small(double_text, value.cast("double"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


assert set(META_COERCIONS) == set(META_TYPES)
