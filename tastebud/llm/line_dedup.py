"""Line deduplication with two Bloom filters.

1. Every task hashes the line keys of its documents and adds them to a *once* and a *twice*
   filter.  The filters are cut into shards by hash; a task ships only the set bit positions,
   and the shards are merged in parallel: a bit seen in the once filters of two tasks goes to
   the twice filter.  A key held by two documents therefore always has all its twice bits set.
2. A second scan keeps only lines whose key hits the twice filter (suspected repeats).  Only
   these shuffle: grouped by the key's text they give the exact number of documents and the
   smallest doc_id.
3. The lines to drop are collected per document and joined to the documents.

The twice filter is the only thing broadcast.  Its size is a parameter with a fixed upper
bound (``MAX_FILTER_BITS``); a corpus too large for it makes more lines suspected, never a
wrong result.

Defined cases: null or empty text has one empty line; a document without doc_id keeps all its
lines and is no evidence of repetition; rows that share a doc_id count as one document; an
empty table gives an empty result; further columns pass through ``dedup_lines`` unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import textops as tx

#: 64 MiB of filter at most, whatever the corpus
MAX_FILTER_BITS = 1 << 29
MIN_FILTER_BITS = 1 << 20
SHARD_BITS = 1 << 16
PROBES = 2
BITS_PER_KEY = 12


def _keys(data: np.ndarray, offsets: np.ndarray, min_chars: int):
    """Line spans and, for lines with a key long enough, the stripped span and key hash."""
    s, e, row = tx.line_spans(data, offsets)
    inside = ~tx.SPACE[data]
    at = np.flatnonzero(inside)
    # first and last byte of the line that is no space
    a, b = np.searchsorted(at, s), np.searchsorted(at, e)
    full = np.flatnonzero(b > a)
    ks, ke = at[a[full]], at[b[full] - 1] + 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    long_enough = points[ke] - points[ks] >= min_chars
    full, ks, ke = full[long_enough], ks[long_enough], ke[long_enough]
    return s, e, row, full, ks, ke, tx.span_hashes(data, ks, ke, tx.byte_values(True, 5))


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions (one row per probe) of each hash; all probes of a hash share its shard."""
    shards = tx.U(bits // SHARD_BITS)
    base = ((h >> tx.U(40)) % shards) * tx.U(SHARD_BITS)
    return np.stack([base + ((h >> tx.U(16 * j)) & tx.U(SHARD_BITS - 1)) for j in range(PROBES)])


def _emit_bits(batches, bits: int, min_chars: int):
    """Per task: shard, positions seen once, positions seen in two documents."""
    schema = pa.schema([("shard", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def flush(parts):
        h, doc = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        fresh = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))
        h = h[fresh]
        again = np.append(False, h[1:] == h[:-1])
        kinds = [np.unique(_positions(x, bits)) for x in (h, h[again])]
        shards = np.unique(kinds[0] // tx.U(SHARD_BITS))
        cuts = [[np.searchsorted(k, x * tx.U(SHARD_BITS)) for k in kinds] for x in [*shards, shards[-1] + tx.U(1)]]
        packed = [(k % tx.U(SHARD_BITS)).astype(np.uint16) for k in kinds]
        cells = [[packed[i][cuts[n][i]: cuts[n + 1][i]].tobytes() for n in range(len(shards))] for i in (0, 1)]
        return pa.RecordBatch.from_arrays(
            [pa.array(shards.astype(np.int32)), pa.array(cells[0], pa.binary()), pa.array(cells[1], pa.binary())], schema=schema)

    parts, held = [], 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in tx.text_blocks(batch.column(1)):
            *_, row, full, _, _, h = _keys(data, offsets, min_chars)
            if len(h):
                parts.append((h, ids[a:b][row[full]]))
                held += len(h)
        if held > 400_000:
            yield flush(parts)
            parts, held = [], 0
    if parts:
        yield flush(parts)


def _merge_shards(batches):
    """Rows of one partition sorted by shard -> the shard's twice filter (packed bits)."""
    schema = pa.schema([("shard", pa.int32()), ("bits", pa.binary())])
    current, once, twice = None, None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())], schema=schema)

    for batch in batches:
        for shard, p1, p2 in zip(*(c.to_pylist() for c in batch.columns)):
            if shard != current:
                if current is not None and twice.any():
                    yield out()
                current, once, twice = shard, np.zeros(SHARD_BITS, bool), np.zeros(SHARD_BITS, bool)
            p1, p2 = np.frombuffer(p1, np.uint16), np.frombuffer(p2, np.uint16)
            twice[p1[once[p1]]] = True
            twice[p2] = True
            once[p1] = True
    if current is not None and twice.any():
        yield out()


def twice_filter(docs: DataFrame, id_col: str, text_col: str, min_chars: int, bits: int) -> np.ndarray:
    """The merged filter of keys seen in two documents, as packed bits (``bits // 8`` bytes)."""
    seen = (docs.select(F.col(id_col).cast("long"), F.col(text_col))
            .mapInArrow(lambda it: _emit_bits(it, bits, min_chars), "shard int, once binary, twice binary"))
    shards = (seen.repartition("shard").sortWithinPartitions("shard")
              .mapInArrow(_merge_shards, "shard int, bits binary"))
    merged = np.zeros(bits // 8, np.uint8)
    width = SHARD_BITS // 8
    for r in shards.toLocalIterator():  # at most bits / SHARD_BITS rows, bits / 8 bytes in all
        merged[r.shard * width: (r.shard + 1) * width] = np.frombuffer(r.bits, np.uint8)
    return merged


def filter_bits(n_lines: int) -> int:
    bits = MIN_FILTER_BITS
    while bits < min(n_lines * BITS_PER_KEY, MAX_FILTER_BITS):
        bits *= 2
    return bits


def _suspects(batches, packed, bits: int, min_chars: int):
    """(doc_id, key text, line numbers) of lines whose key hits the twice filter."""
    schema = pa.schema([("doc", pa.int64()), ("key", pa.binary()), ("line", pa.int32())])
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] = lut[97:123]
    twice = packed.value
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in tx.text_blocks(batch.column(1)):
            s, _, row, full, ks, ke, h = _keys(data, offsets, min_chars)
            if not len(h):
                continue
            hit = np.ones(len(h), bool)
            for p in _positions(h, bits):
                hit &= (twice[p >> tx.U(3)] >> (tx.U(7) - (p & tx.U(7))).astype(np.uint8)) & 1 == 1
            hit = np.flatnonzero(hit)
            if not len(hit):
                continue
            first = np.searchsorted(row, np.arange(b - a))
            raw = lut[data].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a:b][row[full[hit]]]),
                 pa.array([raw[x:y] for x, y in zip(ks[hit].tolist(), ke[hit].tolist())], pa.binary()),
                 pa.array((full[hit] - first[row[full[hit]]]).astype(np.int32))], schema=schema)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Rows (doc, lines): the line numbers each document loses to a document with a smaller id."""
    spark = docs.sparkSession
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    n_lines = named.agg(F.sum(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    bits = filter_bits(n_lines)
    packed = spark.sparkContext.broadcast(twice_filter(named, "doc", "text", min_chars, bits))
    lines, _ = materialize(named.mapInArrow(lambda it: _suspects(it, packed, bits, min_chars), "doc long, key binary, line int"))
    # a key held by one document only (a false suspect, or repeated inside it) drops out here
    owners = (lines.groupBy("key").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
              .where("owner < last").select(F.col("key").alias("k"), "owner"))
    # written, so that the join has exchanges of its own, whose hot keys Spark can split
    owners, _ = materialize(owners)
    return (lines.join(owners, F.col("key") == F.col("k")).where("doc <> owner")
            .groupBy("doc").agg(F.collect_set("line").alias("lines")))


def _apply(batches, n_in: int):
    """Rebuild each text without its dropped lines; adds n_lines, n_dropped."""
    for batch in tx.small_batches(batches):
        kept, total, lost = [], [], []
        for text, drop in zip(batch.column(n_in).to_pylist(), batch.column(n_in + 1).to_pylist()):
            parts = (text or "").split("\n")
            total.append(len(parts))
            if drop:
                gone = set(drop)
                kept.append("\n".join([x for i, x in enumerate(parts) if i not in gone]))
                lost.append(len([i for i in gone if i < len(parts)]))
            else:
                kept.append(text or "")
                lost.append(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(n_in)] + [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(lost, pa.int64())],
            names=[f"c{i}" for i in range(n_in)] + ["kept", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """All columns of ``docs`` as ``c0..``, in order, then kept (the remaining text), n_lines, n_dropped."""
    drops = repeated_lines(docs, id_col, text_col, min_chars)
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    key = f"c{names.index(id_col)}"
    both = plain.join(drops, plain[key].cast("long") == drops["doc"], "left")
    both = both.select(*plain.columns, F.col(f"c{names.index(text_col)}").alias("text_in"), F.col("lines"))
    n = len(names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema) + ", kept string, n_lines long, n_dropped long"
    return both.mapInArrow(lambda it: _apply(it, n), schema)


def line_dedup_stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with its texts reduced to the kept lines; same columns."""
    done = dedup_lines(docs, id_col, text_col, min_chars)
    return done.select(*[(F.col("kept") if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
