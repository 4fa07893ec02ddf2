"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become pieces of at most ``capacity`` tokens (only longer documents are cut; their
first piece takes the remainder).  Which piece goes where depends only on how many pieces of
each length there are, so the search works on that histogram: at most ``capacity`` numbers,
however many documents.  It is a bin completion branch and bound: take the largest length
left, enumerate the undominated ways to fill the rest of its sequence, apply the chosen filling
as often as the counts allow, and go on with what is left.  Branches are pruned by their waste
against the incumbent; the first incumbent is the best-fit solution.  The plan is a list of
fillings with multiplicities; every piece finds its place from its length and its rank among
the pieces of that length, which Spark numbers in cells of bounded size.

Defined cases: null text is an empty text (one piece holding only the end id); documents
without doc_id are packed like others; repeated rows are packed once per row; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import materialize
from . import bpe
from . import textops as tx

CAPACITY = 1024
END_ID = 2
#: nodes the branch and bound may open before it returns its incumbent
NODE_BUDGET = 3000
#: fillings looked at for one largest document
FILLINGS = 24
#: pieces numbered by one window group, about
CELL_ROWS = 100_000


def _pieces(batches, path: str, capacity: int, end_id: int, keep_ids: bool):
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * keep_ids)
    table = bpe.table_for(path)
    for batch in batches:
        for a, b, data, offsets in tx.text_blocks(batch.column(1)):
            ids, count = table.encode(data, offsets)
            stop = np.cumsum(count)
            flat = np.insert(ids.astype("<u4"), stop, end_id)
            n = count + 1
            base = np.concatenate([[0], np.cumsum(n)])[:-1]
            pieces = -(-n // capacity)
            doc = np.repeat(np.arange(b - a), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = n[doc] - (pieces[doc] - 1) * capacity
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            at = (base[doc] + start) * 4
            raw = memoryview(flat.tobytes())
            spans = list(zip(at.tolist(), (at + length * 4).tolist()))
            columns = [batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                       pa.array(start), pa.array(length.astype(np.int32)), pa.array([zlib.crc32(raw[x:y]) for x, y in spans], pa.int64())]
            if keep_ids:
                columns.append(pa.array([bytes(raw[x:y]) for x, y in spans], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids as little-endian uint32])."""
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids binary" * keep_ids
    return (docs.select(F.col(id_col).cast("long"), F.col(text_col))
            .mapInArrow(lambda it: _pieces(it, tokenizer, capacity, end_id, keep_ids), schema))


# ------------------------------------------------------------------------ the plan

def _largest_at_most(lengths: np.ndarray, counts: np.ndarray, room: int) -> int:
    i = int(np.searchsorted(lengths, room, side="right")) - 1
    while i >= 0 and counts[lengths[i]] == 0:
        i -= 1
    return int(lengths[i]) if i >= 0 else 0


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Fill each sequence with the largest piece left, then the largest that fits, and so on."""
    counts = counts.copy()
    plan = []
    lengths = np.flatnonzero(counts)
    while len(lengths := lengths[counts[lengths] > 0]):
        filling, left, room = [], counts.copy(), capacity
        while room and (x := _largest_at_most(lengths, left, room)):
            filling.append(x)
            left[x] -= 1
            room -= x
        plan.append((_apply(counts, tuple(filling)), tuple(filling)))
    return plan


def _apply(counts: np.ndarray, filling: tuple[int, ...]) -> int:
    """Take the filling from the counts as often as they allow; the number of times."""
    kinds, uses = np.unique(filling, return_counts=True)
    times = int((counts[kinds] // uses).min())
    counts[kinds] -= times * uses
    return times


def undominated(counts: np.ndarray, capacity: int, most_waste: int, limit: int = FILLINGS) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, filling) of sequences around the largest length, least waste first.

    A filling is dominated if a piece left out fits into its waste, alone or in place of one
    smaller piece; a filling without waste by one piece dominates all others.
    """
    lengths = np.flatnonzero(counts)
    top = int(lengths[-1])
    room = capacity - top
    left = counts.copy()
    left[top] -= 1
    if room == 0 or (room < len(left) and left[room] > 0):
        return [(0, (top, room) if room else (top,))]
    found: dict[tuple[int, ...], int] = {}
    steps = 0

    def is_undominated(rest: list[int], waste: int) -> bool:
        if _largest_at_most(lengths, left, waste):
            return False
        return all(_largest_at_most(lengths, left, y + waste) <= y for y in set(rest))

    def fill(rest: list[int], room: int, most: int) -> None:
        nonlocal steps
        steps += 1
        if steps > 40 * limit or len(found) >= limit:
            return
        x = _largest_at_most(lengths, left, min(room, most))
        if not x:
            if room <= most_waste and is_undominated(rest, room):
                found.setdefault((top, *rest), room)
            return
        branch = 0
        while x and branch < 6:
            left[x] -= 1
            fill([*rest, x], room - x, x)
            left[x] += 1
            x = _largest_at_most(lengths, left, x - 1)
            branch += 1

    fill([], room, room)
    return sorted((w, f) for f, w in found.items())[:limit]


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, node_budget: int = NODE_BUDGET) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths in one sequence): few sequences holding ``counts[length]`` pieces of each length."""
    start = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        start[length] = n
    tokens = int((start * np.arange(capacity + 1)).sum())
    if not tokens:
        return []
    least = -(-tokens // capacity)
    best = _best_fit(start, capacity)
    fewest = sum(t for t, _ in best)
    nodes = 0

    def search(counts: np.ndarray, waste: int, plan: list) -> None:
        nonlocal best, fewest, nodes
        trail = len(plan)
        while True:
            if nodes >= node_budget or fewest == least:
                break
            if not counts.any():
                if (n := sum(t for t, _ in plan)) < fewest:
                    best, fewest = list(plan), n
                break
            nodes += 1
            # waste that still leads to fewer sequences than the incumbent
            spare = (fewest - 1) * capacity - tokens - waste
            options = undominated(counts, capacity, spare)
            if not options or spare < 0:
                break
            for w, filling in options[1:][::-1]:
                stack.append((counts.copy(), waste, list(plan), filling, w))
            w, filling = options[0]
            times = _apply(counts, filling)
            plan.append((times, filling))
            waste += w * times
        del plan[trail:]

    stack: list = []
    search(start.copy(), 0, [])
    while stack and nodes < node_budget and fewest > least:
        counts_, waste, plan, filling, w = stack.pop()
        times = _apply(counts_, filling)
        search(counts_, waste + w * times, [*plan, (times, filling)])
    return best


def _intervals(plan: list[tuple[int, tuple[int, ...]]], capacity: int):
    """For each length, ranges of ranks with the sequence of the first and the place in it."""
    rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for times, filling in plan:
        place = 0
        for length in filling:
            rows.append((length, int(rank[length]), sequence, place))
            rank[length] += times
            place += length
        sequence += times
    rows.sort()
    length, first, seq, place = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 4
    return (length << 44) + first, seq, place


def _place(batches, shared, names):
    keys, seq, place = shared.value
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        key = (length << 44) + batch.column("rank").to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, key, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + [pa.array(seq[at] + key - keys[at]), pa.array(place[at])],
            names=[*names, "sequence_id", "offset"])


def assign_places(pieces: DataFrame, capacity: int = CAPACITY, node_budget: int = NODE_BUDGET) -> DataFrame:
    """``pieces`` (any rows with doc_id, piece, length) plus sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r.length: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    plan = plan_packing(counts, capacity, node_budget)
    shared = spark.sparkContext.broadcast(_intervals(plan, capacity))  # a few rows per filling of the plan
    cells = max(1, -(-max(counts.values(), default=0) // CELL_ROWS))
    dealt = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(cells)).cast("int"))
    before = (dealt.groupBy("length", "cell").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)))
              .select(F.col("length").alias("l"), F.col("cell").alias("c"), F.coalesce("before", F.lit(0)).alias("before")))
    own = F.row_number().over(W.partitionBy("length", "cell").orderBy("doc_id", "piece")) - 1
    ranked = dealt.withColumn("own", own).join(before, (F.col("length") == F.col("l")) & (F.col("cell") == F.col("c")))
    names = pieces.columns
    ranked = ranked.select(*names, (F.col("own") + F.col("before")).cast("long").alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(lambda it: _place(it, shared, names), schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, keep_ids: bool = False, node_budget: int = NODE_BUDGET) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and its place there."""
    pieces, _ = materialize(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, keep_ids))
    return assign_places(pieces, capacity, node_budget)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences themselves, from pieces that kept their ids."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "length", F.hex("ids").alias("ids"))))
    return (placed.groupBy("sequence_id").agg(rows.alias("rows"))
            .select("sequence_id", F.aggregate("rows", F.lit(0), lambda a, r: a + r["length"]).alias("n_tokens"),
                    F.unhex(F.array_join(F.transform("rows", lambda r: r["ids"]), "")).alias("ids")))
