"""Token counts that follow edits, by a segment tree per document.

A document is cut at white space into leaves of about ``LEAF_CHARS`` characters; over them
stands a segment tree of character and token sums.  An edit walks down the character sums
to the leaves it touches.  Only their text, and the next leaf's where the edit joins two
words across a leaf's end, is encoded again; the sums above them are then put right.  The
vocabulary in use joins nothing across white space, so counts equal those of encoding the
whole text.

Trees are kept in a table (one row per document, with its text), and updated row by row;
nothing is shuffled but edits that come as a table of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.tokens import default_tokenizer, word_tokens
from sheetloom.session import durable

LEAF_CHARS = 240
GROUP_CHARS = 2 << 20
_SPACE = re.compile(r"[ \t-\r]")
STATE = "leaf_chars array<int>, tree array<int>"
EDITS = "array<struct<at: int, drop: int, put: string>>"


def leaves(text: str) -> list[str]:
    """The text cut after white space, in leaves of ``LEAF_CHARS`` characters or little more."""
    out, done = [], 0
    while len(text) - done > LEAF_CHARS:
        blank = _SPACE.search(text, done + LEAF_CHARS - 1)
        if not blank:
            break
        out.append(text[done:blank.end()])
        done = blank.end()
    return out + [text[done:]]


def sums(values) -> list[int]:
    """A segment tree as a heap: node i stands over 2i and 2i + 1; the leaves come last."""
    size = 1
    while size < len(values):
        size *= 2
    tree = np.zeros(2 * size, dtype=np.int64)
    tree[size:size + len(values)] = values
    while size > 1:
        tree[size // 2:size] = tree[size:2 * size:2] + tree[size + 1:2 * size:2]
        size //= 2
    return tree.tolist()


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about GROUP_CHARS characters together, to bound a step's memory."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > GROUP_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _cut_and_counted(texts: list[str], tokens) -> Iterator[tuple[list[str], np.ndarray]]:
    """Leaves and their token counts, text by text."""
    cut = [leaves(t) for t in texts]
    counts = tokens.counts([leaf for doc in cut for leaf in doc])
    end = 0
    for doc in cut:
        yield doc, counts[end:end + len(doc)]
        end += len(doc)


class CountedText:
    """One document: its leaves and the two trees over them."""

    def __init__(self, parts: list[str], chars: list[int], tokens: list[int]):
        self.parts, self.chars, self.tokens = parts, chars, tokens
        self.encoded_again = 0

    @classmethod
    def restored(cls, text: str, leaf_chars, tree) -> CountedText:
        ends = np.cumsum(leaf_chars).tolist()
        parts = [text[a:b] for a, b in zip([0, *ends], ends)]
        return cls(parts, sums(leaf_chars), list(tree))

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, and where it begins."""
        node, size, begin = 1, len(self.chars) // 2, 0
        while node < size:
            node *= 2
            if at >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return min(node - size, len(self.parts) - 1), begin

    def _set(self, tree: list[int], leaf: int, value: int) -> None:
        node = leaf + len(tree) // 2
        change = value - tree[node]
        while node and change:
            tree[node] += change
            node //= 2

    def edit(self, at: int, drop: int, put: str | None, count) -> None:
        """Replace ``drop`` characters from ``at`` on by ``put``; positions beyond the text
        mean its end."""
        at = min(max(at, 0), self.chars[1])
        first, begin = self._find(at)
        last, text, put = first, self.parts[first], put or ""
        stop = at - begin + max(drop, 0)
        while stop > len(text) and last + 1 < len(self.parts):
            last += 1
            text += self.parts[last]
        text = text[:at - begin] + put + text[stop:]
        while text and not _SPACE.match(text[-1]) and last + 1 < len(self.parts):
            last += 1               # the edit took the space that parted two leaves
            text += self.parts[last]
        # an emptied region may leave the leaf before as the end of the text: nothing to do
        new = leaves(text)
        counts = count(new)
        self.encoded_again += len(text)
        if len(new) <= last - first + 1:
            new += [""] * (last - first + 1 - len(new))
            for leaf, part, n in zip(range(first, last + 1), new, [*counts, *[0] * len(new)]):
                self.parts[leaf] = part
                self._set(self.chars, leaf, len(part))
                self._set(self.tokens, leaf, int(n))
        else:                       # more leaves than before: the trees are laid anew over known counts
            known = self.tokens[len(self.tokens) // 2:][:len(self.parts)]
            self.parts[first:last + 1] = new
            known[first:last + 1] = [int(n) for n in counts]
            self.chars, self.tokens = sums([len(p) for p in self.parts]), sums(known)


def build(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, text, leaf_chars, tree`` for each row; ``tree[1]`` is the token count.

    A null text is empty: one empty leaf and a count of 0.  Other columns are ignored.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = word_tokens(path)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for a, b in _groups(texts):
                found = list(_cut_and_counted(texts[a:b], tokens))
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[a:b].astype("Int64").to_numpy(), "text": texts[a:b],
                    "leaf_chars": [[len(leaf) for leaf in doc] for doc, _ in found],
                    "tree": [sums(counts) for _, counts in found]})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        run, f"doc_id long, text string, {STATE}")


def gathered(edits: DataFrame) -> DataFrame:
    """``doc_id, edits`` from ``doc_id, seq, at, drop, put``: edits in the order of ``seq``.

    The edits of one document are applied one after another, so they stay together.
    """
    return (edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "at", "drop", "put"))).alias("e"))
            .select("doc_id", F.transform("e", lambda x: F.struct(x["at"], x["drop"], x["put"])).alias("edits")))


def update(state: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``state`` rows with an ``edits`` column -> the state after the edits, with
    ``n_before, n_edits, n_tokens, encoded_again``.

    Each edit refers to the text that the edits before it left.  Null edits are none.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = word_tokens(path).counts
        for batch in batches:
            out = []
            for doc_id, text, leaf_chars, tree, edits in batch.itertuples(index=False):
                if edits is None or not len(edits):
                    out.append((doc_id, text, leaf_chars, tree, tree[1], 0, tree[1], 0))
                    continue
                doc = CountedText.restored(text, leaf_chars, tree)
                for e in edits:
                    doc.edit(int(e["at"]), int(e["drop"]), e["put"], count)
                out.append((doc_id, doc.text, doc.chars[len(doc.chars) // 2:][:len(doc.parts)], doc.tokens,
                            tree[1], len(edits), doc.tokens[1], doc.encoded_again))
            frame = pd.DataFrame(out, columns=columns)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = (f"doc_id long, text string, {STATE}, n_before long, n_edits long, n_tokens long, "
              "encoded_again long")
    columns = [c.split()[0] for c in schema.split(", ")]
    return (state.select("doc_id", "text", "leaf_chars", "tree", "edits").mapInPandas(run, schema))


_PERSONAL = re.compile(
    r"(?P<mail>[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"
    r"|(?P<phone>\+\d{1,3} \(\d{3}\) \d{3}-\d{4})|(?P<address>\b\d{1,3}(?:\.\d{1,3}){3}\b)")


def redactions(text: str | None) -> list[tuple[int, int, str]]:
    """Edits (at, drop, put) that replace mail addresses, telephone numbers and network
    addresses by their kind; from the end of the text to its start, so that positions hold."""
    found = list(_PERSONAL.finditer(text)) if text else []
    return [(m.start(), m.end() - m.start(), f"[{m.lastgroup}]") for m in reversed(found)]


def redacted(state: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_after, encoded_again`` of stored trees
    (:func:`build`): the counts before and after personal data is redacted.

    Only the leaves that a redaction touches are encoded; documents without one are
    answered by the root of their tree.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = word_tokens(path).counts
        for batch in batches:
            out = []
            for text, leaf_chars, tree in zip(batch["text"], batch["leaf_chars"], batch["tree"]):
                edits = redactions(text)
                before = after = int(tree[1])
                encoded = 0
                if edits:
                    doc = CountedText.restored(text, leaf_chars, tree)
                    for at, drop, put in edits:
                        doc.edit(at, drop, put, count)
                    after, encoded = doc.tokens[1], doc.encoded_again
                out.append((before, len(edits), after, encoded))
            frame = pd.DataFrame(out, columns=["n_tokens", "n_edits", "n_tokens_after", "encoded_again"])
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield frame

    return state.select("doc_id", "text", "leaf_chars", "tree").mapInPandas(
        run, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, encoded_again long")


def redacted_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The trees of all rows of ``docs``, stored as a table, and the counts of
    :func:`redacted` from that table.  A null text is empty; each row gives a row."""
    return redacted(durable(build(docs, tokenizer)), tokenizer)
