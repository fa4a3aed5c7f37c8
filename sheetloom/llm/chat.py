"""Conversations to training text and back, with DataFrame functions only.

Template: ``<s>``, then blocks.  A block is opened and closed by its role's control
strings and holds the texts of adjacent turns of that role, parted by ``<|turn|>``.
Assistant text is what the loss is taken on.

A control string inside a text is broken by ESC 1 after its first character, and an ESC of
the text is written ESC 0, so that ``unescaped`` gives every text back unchanged.  No
control string can arise where a text meets the template: none of them ends as another
begins.

Turns are collected in chunks of ``CHUNK`` turn numbers and a conversation is the
concatenation of its chunks, so that one with very many turns is sorted in many groups
and only its finished text, one value, stands in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHUNK = 64
ESC = ""
BEGIN, TURN = "<s>", "<|turn|>"
OPEN = {"system": "<<SYS>> ", "user": "[INST] ", "assistant": "<|answer|>"}
CLOSE = {"system": " <</SYS>>", "user": " [/INST]", "assistant": "</s>"}
# any other role: its (escaped) name stands in the block
OTHER_OPEN, OTHER_NAME, OTHER_CLOSE, NO_ROLE = "<|role|>", "<|text|>", "<|end|>", "<|none|>"
# what follows the first character of each control string
_REST = r"(?=s>|/s>|/?INST\]|</?SYS>>|\|(?:turn|answer|role|text|end|none)\|>)"


def escaped(text: Column) -> Column:
    once = F.replace(text, F.lit(ESC), F.lit(ESC + "0"))
    return F.regexp_replace(once, r"([<\[])" + _REST, "$1" + ESC + "1")


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESC + "1"), F.lit("")), F.lit(ESC + "0"), F.lit(ESC))


def _opening(role: Column) -> Column:
    named = F.coalesce(escaped(role), F.lit(NO_ROLE))
    out = F.concat(F.lit(OTHER_OPEN), named, F.lit(OTHER_NAME))
    for name, mark in OPEN.items():
        out = F.when(role.eqNullSafe(F.lit(name)), F.lit(mark)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(OTHER_CLOSE)
    for name, mark in CLOSE.items():
        out = F.when(role.eqNullSafe(F.lit(name)), F.lit(mark)).otherwise(out)
    return out


def _joint(before: Column, role: Column) -> Column:
    """What stands between two turns."""
    return F.when(before.eqNullSafe(role), F.lit(TURN)).otherwise(F.concat(_closing(before), _opening(role)))


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted`` for each conversation of ``conv_id, turn, role, text``.

    Rows are ordered by turn (nulls first), ties by role and text; repeated rows are turns
    of their own.  A null text is empty; a null or unknown role gets a block of its own
    kind.  Rows with a null conv_id are one conversation.  Other columns are ignored; an
    empty table gives no row.
    """
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"),
                        F.floor(F.col("turn") / CHUNK).alias("chunk"))
    chunks = (rows.groupBy("conv_id", "chunk")
              .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
              .select("conv_id", "chunk", F.get("t", F.lit(0))["role"].alias("first"),
                      F.element_at("t", -1)["role"].alias("last"),
                      F.array_join(F.transform("t", lambda x, i: F.concat(
                          F.when(i == 0, F.lit("")).otherwise(_joint(F.get("t", i - 1)["role"], x["role"])),
                          escaped(x["text"]))), "").alias("body")))
    return (chunks.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("chunk", "first", "last", "body"))).alias("c"))
            .select("conv_id", F.concat(
                F.lit(BEGIN), _opening(F.get("c", F.lit(0))["first"]),
                F.array_join(F.transform("c", lambda x, i: F.concat(
                    F.when(i == 0, F.lit("")).otherwise(_joint(F.get("c", i - 1)["last"], x["first"])),
                    x["body"])), ""),
                _closing(F.element_at("c", -1)["last"])).alias("formatted")))


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "[]|/<>" else c for c in text)


_OPENINGS = "|".join([_quoted(m) for m in OPEN.values()]
                     + [f"{_quoted(OTHER_OPEN)}.*?{_quoted(OTHER_NAME)}"])
_CLOSINGS = "|".join(_quoted(m) for m in (*CLOSE.values(), OTHER_CLOSE))
_BLOCK = f"(?s)({_OPENINGS})(.*?)({_CLOSINGS})"


def read_back(texts: DataFrame) -> DataFrame:
    """``conv_id, turns`` from ``conv_id, formatted``: the turns as array<struct<role, text>>."""
    opening = F.regexp_extract_all("formatted", F.lit(_BLOCK), F.lit(1))
    body = F.regexp_extract_all("formatted", F.lit(_BLOCK), F.lit(2))
    blocks = texts.select("conv_id", F.arrays_zip(opening.alias("opening"), body.alias("body")).alias("b"))
    name = F.regexp_extract  # of other roles

    def role(mark: Column) -> Column:
        inner = name(mark, f"(?s)^{_quoted(OTHER_OPEN)}(.*){_quoted(OTHER_NAME)}$", 1)
        out = F.when(inner != NO_ROLE, unescaped(inner))
        for known, opened in OPEN.items():
            out = F.when(mark == opened, F.lit(known)).otherwise(out)
        return out

    return blocks.select("conv_id", F.flatten(F.transform("b", lambda x: F.transform(
        F.split(x["body"], _quoted(TURN), -1),
        lambda text: F.struct(role(x["opening"]).alias("role"), unescaped(text).alias("text"))))).alias("turns"))


def loss_text(text: Column) -> Column:
    """All assistant text of a formatted conversation, unescaped, nothing between."""
    marks = f"{_quoted(OPEN['assistant'])}|{_quoted(CLOSE['assistant'])}"
    parts = F.filter(F.split(text, marks, -1), lambda _, i: i % 2 == 1)     # every second part is inside
    return unescaped(F.replace(F.array_join(parts, ""), F.lit(TURN), F.lit("")))


def digest(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, all
    read back from the formatted text."""
    texts = formatted(turns)
    back = (texts.select("conv_id", "formatted", loss_text(F.col("formatted")).alias("loss")))
    named = read_back(back.select(F.struct("conv_id", "formatted", "loss").alias("conv_id"), "formatted"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(
        F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return named.select(
        "conv_id.conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("conv_id.loss").cast("long").alias("loss_chars"),
        F.sha2("conv_id.loss", 256).alias("loss_sha256"),
        F.length("conv_id.formatted").cast("long").alias("formatted_chars"))
