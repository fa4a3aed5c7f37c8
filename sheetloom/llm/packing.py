"""Pack documents into sequences of a fixed number of tokens, in as few as possible.

The lengths of all pieces form a histogram of at most ``capacity`` entries, whatever the
number of documents.  Over it stands the configuration linear program: a configuration is
a multiset of lengths that fits one sequence; use as few as cover the histogram.  It is
solved by multiplicative weights: every length has a price, a knapsack dynamic program
finds the configurations of the greatest price, a share of the demand is taken by each, and
the prices of the lengths they hold fall in proportion to what was covered.  That goes on
until every length is covered.  The solution is rounded down to whole sequences, which
leaves less than one sequence to a length; these pieces go best-fit into further sequences,
equal ones together.

Spark tokenizes, counts, ranks the pieces of each length and looks up their places; only
the histogram and the plan meet the driver.  Both are bounded by the capacity, whatever the
number of pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sheetloom.llm.tokens import default_tokenizer, word_tokens
from sheetloom.session import durable

CAPACITY = 2048
END = 0                   # id that closes a document
STEP = 0.25               # share of its scarcest length's whole demand that a configuration covers
SLACK = 0.05              # how far below the best price a configuration of the same round may be
LONG_BONUS = 0.1
BUCKETS = 64              # parts that the pieces of one length are ranked in


# --- pieces -----------------------------------------------------------------------

def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
           keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) for each piece of each row."""
    path = tokenizer or default_tokenizer()
    end = np.array([END], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at in range(0, len(doc_ids), 2048):
                rows = []
                texts = batch.column(1).slice(at, 2048).to_pylist()
                for doc_id, ids in zip(doc_ids[at:at + 2048], tokens.texts(texts)):
                    whole = ids.tobytes() + end
                    for k, i in enumerate(range(0, len(whole), 4 * capacity)):
                        chunk = whole[i:i + 4 * capacity]
                        row = (doc_id, k, i // 4, len(chunk) // 4, zlib.crc32(chunk))
                        rows.append((*row, np.frombuffer(chunk, "<u4").tolist()) if keep_ids else row)
                columns = list(zip(*rows)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))

    fields = [pa.field("doc_id", pa.int64()), pa.field("piece", pa.int32()), pa.field("start", pa.int64()),
              pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if keep_ids:
        fields.append(pa.field("ids", pa.list_(pa.int64())))
        schema += ", ids array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


# --- the plan ---------------------------------------------------------------------

@dataclass
class Plan:
    """Places by length and rank: the pieces of ``length`` with ranks from ``first`` on lie
    ``per`` to a sequence, from sequence ``base`` and offset ``offset`` on."""
    length: np.ndarray
    first: np.ndarray
    base: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    sequences: int


def _knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest total price within each room up to the capacity, and a length that has part in it."""
    by_length = np.full(capacity + 1, -1.0)
    by_length[lengths] = prices
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, dtype=np.int64)
    low = int(lengths.min())
    for c in range(low, capacity + 1):
        value = by_length[low:c + 1] + best[c - low::-1]
        k = int(value.argmax())
        if value[k] > best[c - 1]:
            best[c], taken[c] = value[k], low + k
        else:
            best[c] = best[c - 1]
    return best, taken


def _configuration(taken: np.ndarray, n: int, capacity: int) -> dict[int, int]:
    """The multiset of the greatest price among those that hold length ``n``."""
    held, c = {n: 1}, capacity - n
    while c > 0:
        k = int(taken[c])
        if k:
            held[k] = held.get(k, 0) + 1
        c -= k or 1
    return held


def most_rounds(lengths: int, step: float = STEP) -> int:
    """Rounds that surely cover so many lengths: each takes at least half a step of some
    length's demand, or what is left of it but a part of one configuration, or that part."""
    return lengths * (int(np.ceil(2 / step)) + 2)


def solve(counts: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None,
          step: float = STEP) -> list[tuple[dict[int, int], float]]:
    """Configurations with their multiplicities: the linear program's solution.

    Prices start near the lengths' share of the capacity, which is a feasible dual (a
    little more for long ones, that are hard to place late), and fall by exp(-covered
    share); a length that is covered leaves the program.  One dynamic program serves a
    round: it gives the best configuration through each length, of which those near the
    best price are taken that share no length.  Multiplicities are whole as long as one
    whole sequence can be filled; a part of one always ends a length.  ``rounds`` ends the
    program early; by itself it runs until all is covered.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    demand = np.array([counts[int(n)] for n in lengths], dtype=np.float64)
    rest = demand.copy()
    prices = lengths / capacity * (1 + LONG_BONUS * lengths / capacity)
    place = {int(n): i for i, n in enumerate(lengths)}
    solution = []
    for _ in range(most_rounds(len(lengths), step) if rounds is None else rounds):
        open_ = np.flatnonzero(rest > 1e-9 * demand)
        if not open_.size:
            break
        best, taken = _knapsack(prices[open_], lengths[open_], capacity)
        through = prices[open_] + best[capacity - lengths[open_]]
        used: set[int] = set()
        for i in np.argsort(-through, kind="stable"):
            if used and through[i] < (1 - SLACK) * best[capacity]:
                break
            n = int(lengths[open_[i]])
            held = _configuration(taken, n, capacity) if n not in used else {}
            if not held or used & held.keys():
                continue
            used |= held.keys()
            at = np.array([place[n] for n in held])
            copies = np.array(list(held.values()), dtype=np.float64)
            room = (rest[at] / copies).min()
            whole = int(min(room + 1e-9, max(1.0, step * (demand[at] / copies).min())))
            amount = float(whole or room)
            rest[at] = np.maximum(0.0, rest[at] - copies * amount)
            prices[at] *= np.exp(-step * copies * amount / demand[at])
            solution.append((held, amount))
    assert rounds is not None or not (rest > 1e-9 * demand).any()
    return solution


def programmed(counts: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None,
               step: float = STEP) -> tuple[list[tuple[tuple, int]], dict[int, int]]:
    """Whole sequences of the program, as (length, copies) pairs and how often, and what it
    leaves of each length."""
    left = {int(n): int(k) for n, k in counts.items() if k}
    merged: dict[tuple, float] = {}
    for held, amount in solve(left, capacity, rounds, step) if left else []:
        key = tuple(sorted(held.items(), reverse=True))
        merged[key] = merged.get(key, 0.0) + amount
    whole = []
    for key, amount in merged.items():
        times = min(int(amount + 1e-6), *(left[n] // k for n, k in key))
        if times > 0:
            whole.append((key, times))
            for n, k in key:
                left[n] -= k * times
    left = {n: k for n, k in left.items() if k}
    # a part of a sequence ends a length, so the parts are fewer than the lengths
    assert rounds is not None or sum(n * k for n, k in left.items()) <= capacity * len(counts)
    return whole, left


def best_fit(left: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Sequences by best fit, longest first, with equal ones as one entry.

    A piece goes where the least room is left.  So one length fills all sequences of a room
    as far as they hold it before it comes to the next room: each length divides at most
    one kind of sequence, and makes at most two.
    """
    kinds: list[list[tuple[tuple, int]]] = [[] for _ in range(capacity + 1)]     # by their free room
    filled = np.zeros(capacity + 1, dtype=bool)

    def put(room: int, held: tuple, times: int) -> None:
        if times:
            kinds[room].append((held, times))
            filled[room] = True

    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            rooms = np.flatnonzero(filled[n:])
            if rooms.size:
                room = n + int(rooms[0])
                held, times = kinds[room].pop()
                filled[room] = bool(kinds[room])
            else:
                room, held, times = capacity, (), -(-count // (capacity // n))
            per = min(room // n, count)
            took = min(times, count // per)
            put(room, held, times - took if held else 0)
            put(room - per * n, (*held, (n, per)), took)
            count -= per * took
    return [kind for row in kinds for kind in row]


def plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None,
         step: float = STEP) -> Plan:
    """Whole sequences for a histogram of lengths (1 to ``capacity``)."""
    whole, left = programmed(counts, capacity, rounds, step)
    rest = best_fit(left, capacity)
    assert len(rest) <= 3 * len(counts)
    whole += rest
    first = dict.fromkeys(counts, 0)
    entries, base = [], 0
    for key, times in whole:
        offset = 0
        for n, k in key:
            entries.append((n, first[n], base, k, offset))
            first[n] += k * times
            offset += n * k
        base += times
    # a sequence holds fewer than sqrt(2 * capacity) different lengths
    assert rounds is not None or len(entries) <= most_rounds(len(counts), step) * (2 * capacity) ** 0.5
    entries.sort()
    columns = np.array(entries, dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=base)


# --- placing ----------------------------------------------------------------------

_SPAN = np.int64(1) << 48      # ranks below this


def placed(parts: DataFrame, capacity: int = CAPACITY, rounds: int | None = None) -> DataFrame:
    """``parts`` (stored pieces) with ``sequence_id, offset``.

    Ranks within a length are dealt in two levels, so that the pieces of one length are
    never ordered in one task: by bucket totals, then within the bucket.
    """
    dealt = parts.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)))
    totals = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in totals.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    made = plan(histogram, capacity, rounds)
    sent = parts.sparkSession.sparkContext.broadcast(made)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (dealt.withColumn("_rank", F.row_number().over(order) - 1)
              .join(starts, ["length", "_bucket"])
              .withColumn("_rank", (F.col("_rank") + F.col("_start")).cast("long")))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p = sent.value
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        i = np.searchsorted(p.length * _SPAN + p.first, n * _SPAN + r, side="right") - 1
        k = r - p.first[i]
        return pd.DataFrame({"sequence_id": p.base[i] + k // p.per[i],
                             "offset": p.offset[i] + k % p.per[i] * n})

    return (ranked.withColumn("_at", look_up("length", "_rank"))
            .select(*parts.columns, "_at.sequence_id", "_at.offset"))


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
           rounds: int | None = None, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its ids and a closing id 0; a longer one than ``capacity`` is cut there.
    A null or empty text is the closing id alone.  Repeated rows and rows with a null
    doc_id are documents of their own.  With ``keep_ids`` a column of ids follows.  An empty
    table gives no piece.
    """
    return placed(durable(pieces(docs, tokenizer, capacity, keep_ids)), capacity, rounds)
