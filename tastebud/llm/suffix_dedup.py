"""Suffix-array deduplication: remove every byte covered by a ``min_len``-byte string that also
starts earlier in the corpus (smaller doc_id, or the same document and an earlier start).

The suffix array is built by two-stage sorting (``suffix_order``): suffixes smaller than their
successor are sorted directly, all others are induced from them by one scan over the buckets of
first bytes; then the common prefixes of adjacent suffixes are computed and runs of at least
``min_len`` mark the repeats (``repeated_starts``).

To spread one suffix array over a cluster:

1. Every string of ``min_len`` bytes owns an *anchor*, the position of the smallest hash of a
   ``GRAM``-byte window inside it.  Equal strings have equal anchors, so each string only has to
   meet the strings around equal anchors.  The starts that own one anchor form an interval; the
   bytes that its strings cover are the anchor's *context* (about 130 bytes).
2. Equal contexts are pre-aggregated, in the task and then by their hashes: all but the first
   are repeats as a whole, and only the first stays a candidate source.
3. The first occurrences of anchors that have several different contexts (beginnings and ends of
   repeated passages, edits in near copies) bring their bytes; those of one anchor meet in one
   suffix array, many anchors per array.
4. An anchor with more than ``HOT`` different contexts is cut up: its strings are aggregated one
   by one under their 128-bit hash, so no group grows with it.

Strings are judged on the input, and matches never cross documents.

Defined cases: null text is empty; texts shorter than ``min_len`` lose nothing; a document
without doc_id loses nothing and is no source; rows that share a doc_id are one document (equal
places are not earlier than each other; what one row loses the other loses at the same places);
an empty table gives an empty result; further columns pass through the operator.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import materialize
from . import textops as tx

MIN_LEN = 100
GRAM = 32
#: different contexts of one anchor that one suffix array holds at most (about 2 MB)
HOT = 15_000
#: bytes of one suffix array, about; its working memory is some 150 times that
ARRAY_BYTES = 1 << 20
#: bytes scanned for anchors at once
SCAN_BYTES = 1 << 20
SEPARATOR = 0xFF  # never occurs in UTF-8


# ------------------------------------------------------------------------ suffix array

def _words_at(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one big-endian integer (0xFF beyond the end)."""
    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)]).astype(np.uint64)
    out = padded.copy()
    for width in (1, 2, 4):
        out[:-width] = (out[:-width] << tx.U(8 * width)) | out[width:]
    return out[: len(text)]


def _smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the end counts as larger than any byte."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.ones(n, bool)
    if len(change):
        # the next position whose byte differs from its successor decides a run of equal bytes
        decides = change[np.minimum(np.searchsorted(change, np.arange(n)), len(change) - 1)]
        smaller = text[decides] < text[np.minimum(decides + 1, n - 1)]
        smaller[change[-1] + 1:] = True
    return smaller


def _sort_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` ordered by the first ``depth`` bytes of its suffixes (ties by position)."""
    order = at[np.argsort(words[at], kind="stable")]
    if not len(order):
        return order
    key = words[order]
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
    n = len(words)
    for done in range(8, depth, 8):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        g, p = group[tied], order[tied]
        beyond = p + done >= n
        w = words[np.minimum(p + done, n - 1)]
        w[beyond] = tx.U(0xFFFFFFFFFFFFFFFF)
        by = np.lexsort((w, g))
        g, w, order[tied] = g[by], w[by], p[by]
        new = np.append(True, (g[1:] != g[:-1]) | (w[1:] != w[:-1]))
        fresh = np.zeros(len(order), bool)
        fresh[np.searchsorted(group, np.arange(group[-1] + 1))] = True
        fresh[tied[new]] = True
        group = np.cumsum(fresh) - 1
    return order


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``text``, ordered by the first ``depth`` bytes at least, by two-stage sorting.

    The end of the text counts as larger than any byte.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    smaller = _smaller_than_successor(text)
    words = _words_at(text)
    direct = _sort_directly(words, np.flatnonzero(smaller), depth)
    first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=256))])
    own = np.searchsorted(text[direct], np.arange(257))
    order = np.empty(n, np.int64)
    fill = first[:256].copy()  # where the next induced suffix of each bucket goes
    for c in range(256):
        end = first[c + 1]
        a = direct[own[c]: own[c + 1]]
        # those larger than their successor come first in the bucket, the directly sorted ones last
        order[end - len(a): end] = a
        if first[c] == end:
            continue
        scanned = first[c]
        while scanned < end:
            stop = fill[c] if scanned < fill[c] else end
            before = order[scanned:stop] - 1
            scanned = stop
            before = before[before >= 0]
            before = before[~smaller[before]]
            byte = text[before]
            by = np.argsort(byte, kind="stable")
            before, byte = before[by], byte[by]
            count = np.bincount(byte, minlength=256)
            place = fill[byte] + np.arange(len(byte)) - (np.cumsum(count) - count)[byte]
            order[place] = before
            fill += count
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each suffix and the one before it in ``order``, up to ``limit`` bytes (first: 0)."""
    n = len(text)
    words = _words_at(text)
    out = np.zeros(n, np.int64)
    open_ = np.arange(1, n)
    for done in range(0, limit, 8):
        a, b = order[open_ - 1] + done, order[open_] + done
        inside = (a < n) & (b < n)
        open_, a, b = open_[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = differ == 0
        # leading equal bytes of the eight; log2 of a 64-bit integer may round up to the next byte
        d = differ[~same]
        lead = np.zeros(len(d), np.int64)
        for k in range(1, 8):
            lead += (d >> tx.U(64 - 8 * k)) == 0
        out[open_[~same]] = done + lead
        open_ = open_[same]
        out[open_] = done + 8
        if not len(open_):
            break
    return np.minimum(out, np.minimum(limit, n))


def repeated_starts(text: np.ndarray, room: np.ndarray, place: np.ndarray, min_len: int) -> np.ndarray:
    """Positions whose ``min_len``-byte string also occurs at an earlier place.

    ``room``: bytes from each position to the end of its context; ``place``: (document, start) of
    each position as one number; equal numbers are the same place.
    """
    order = suffix_order(text, min_len)
    shared = common_prefixes(text, order, min_len)
    eligible = room[order] >= min_len
    run = np.cumsum(shared < min_len) - 1
    at, run = order[eligible], run[eligible]
    if not len(at):
        return at
    start = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    earliest = np.repeat(np.minimum.reduceat(place[at], start), np.diff(np.append(start, len(at))))
    return at[place[at] > earliest]


# ------------------------------------------------------------------------ anchors

def _gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` (a power of two) bytes from each position."""
    h = tx.byte_values(False, 21)[data]
    step = 1
    while step < width:
        h = h[:-step] * tx.U(0x9E3779B97F4A7C15 + 2 * step) + tx.mix(h[step:]) if len(h) > step else h[:0]
        step *= 2
    return tx.mix(h)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    step, out = 1, v
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, min_len: int, gram: int):
    """Per anchor: text index, position, first and last owning start (in the block), and its gram's hash."""
    z = np.zeros(0, np.int64)
    window = min_len - gram + 1
    if len(data) < min_len:
        return z, z, z, z, np.zeros(0, np.uint64)
    h = _gram_hashes(data, gram)
    bits = max(1, int(len(h)).bit_length())
    low = tx.U((1 << bits) - 1)
    # leftmost position of the smallest hash: position in the low bits
    best = (_sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), window) & low).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(best)), side="right") - 1
    own = np.flatnonzero(np.arange(len(best)) + min_len <= offsets[row + 1])
    if not len(own):
        return z, z, z, z, np.zeros(0, np.uint64)
    new = np.append(True, (best[own[1:]] != best[own[:-1]]) | (own[1:] != own[:-1] + 1))
    start = np.flatnonzero(new)
    lo, hi = own[start], own[np.append(start[1:], len(own)) - 1]
    at = best[lo]
    return row[lo], at, lo, hi, h[at]


_COVER, _ANCHOR = 0, 1
#: of an anchor, at = position << 24 | starts before it << 12 | (last start - position) + 2048;
#: of a known repeat, at = start and context = stop
SCAN = "kind int, doc long, anchor long, context long, at long"


def _pack(pos, before, after):
    return (pos << 24) | (before << 12) | (after + 2048)


def _emit_anchors(batches, min_len: int, gram: int):
    """Per task block: intervals already known to be repeats, and the first occurrence of each context."""
    schema = pa.schema([("kind", pa.int32()), ("doc", pa.int64()), ("anchor", pa.int64()), ("context", pa.int64()), ("at", pa.int64())])
    values = tx.byte_values(False, 22)
    overlap = min_len - 1
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in tx.text_blocks(batch.column(1), SCAN_BYTES):
            # a text longer than a block is scanned in overlapping pieces
            piece = 2 * SCAN_BYTES
            cuts = [0] if len(data) <= piece else range(0, len(data) - overlap, piece)
            for cut in cuts:
                part = data[cut: cut + piece + overlap] if len(data) > piece else data
                ends = np.clip(offsets - cut, 0, len(part)) if len(data) > piece else offsets
                row, at, lo, hi, anchor = anchors(part, ends, min_len, gram)
                if not len(row):
                    continue
                context = tx.span_hashes(part, lo, hi + min_len, values)
                doc, start = ids[a:b][row], cut + at - offsets[row]
                by = np.lexsort((start, doc, context, anchor))
                key = anchor[by], context[by]
                first = np.append(True, (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]))
                source = by[np.flatnonzero(first)[np.cumsum(first) - 1]]
                again = by[(doc[by] != doc[source]) | (start[by] != start[source])]
                first = by[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), _ANCHOR, np.int32)), pa.array(doc[first]), pa.array(tx.as_long(anchor[first])),
                     pa.array(tx.as_long(context[first])), pa.array(_pack(start, at - lo, hi - at)[first])], schema=schema)
                if len(again):
                    # neighbouring intervals as one row, dealt at random
                    again.sort()
                    new = np.append(True, (row[again[1:]] != row[again[:-1]]) | (lo[again[1:]] != hi[again[:-1]] + 1))
                    head = again[new]
                    tail = again[np.append(np.flatnonzero(new)[1:], len(again)) - 1]
                    origin = cut - offsets[row[head]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(head), _COVER, np.int32)), pa.array(doc[head]), pa.array(tx.as_long(tx.mix(anchor[head] ^ tx.mix(doc[head].astype(np.uint64) + lo[head].astype(np.uint64))))),
                         pa.array(origin + hi[tail] + min_len), pa.array(origin + lo[head])], schema=schema)


def _start(at):
    return F.shiftright(at, 24) - F.shiftright(at, 12).bitwiseAND(F.lit(4095))


def _stop(at, min_len: int):
    return F.shiftright(at, 24) + at.bitwiseAND(F.lit(4095)) - 2048 + min_len


def _contexts(batches, min_len: int):
    """(doc, text, sources) -> one row per source with the bytes of its context."""
    schema = pa.schema([("doc", pa.int64()), ("anchor", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary()), ("is_hot", pa.bool_())])
    for batch in tx.small_batches(batches):
        for doc, text, sources in zip(*(c.to_pylist() for c in batch.columns)):
            raw = (text or "").encode()
            spans = [(s["anchor"], s["start"], s["stop"], s["hot"]) for s in sources if s["stop"] <= len(raw)]
            if spans:
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(spans), pa.int64()), pa.array([x[0] for x in spans], pa.int64()), pa.array([x[1] for x in spans], pa.int64()),
                                                  pa.array([raw[x[1]:x[2]] for x in spans], pa.binary()), pa.array([x[3] for x in spans])], schema=schema)


def _array_repeats(batches, min_len: int, size: int):
    """Contexts sorted by anchor -> (doc, start, stop) covered by repeats; one suffix array per stretch of anchors."""
    schema = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])

    def solve(rows):
        doc, start, raw = zip(*rows)
        doc, start = np.array(doc, np.int64), np.array(start, np.int64)
        length = np.array([len(r) for r in raw])
        text = np.frombuffer(bytes([SEPARATOR]).join(raw) + bytes([SEPARATOR]), np.uint8)
        base = np.cumsum(length + 1) - (length + 1)
        which = np.repeat(np.arange(len(raw)), length + 1)
        inside = np.arange(len(text)) - base[which]
        place = (np.unique(doc, return_inverse=True)[1][which] << 40) + start[which] + inside
        found = np.sort(repeated_starts(text, length[which] - inside, place, min_len))
        if not len(found):
            return None
        new = np.append(True, (found[1:] != found[:-1] + 1) | (which[found[1:]] != which[found[:-1]]))
        first, last = found[new], found[np.append(np.flatnonzero(new)[1:], len(found)) - 1]
        return pa.RecordBatch.from_arrays([pa.array(doc[which[first]]), pa.array(start[which[first]] + inside[first]), pa.array(start[which[last]] + inside[last] + min_len)], schema=schema)

    held, held_bytes, current = [], 0, None
    for batch in batches:
        for anchor, doc, start, raw in zip(*(c.to_pylist() for c in batch.columns)):
            if anchor != current and held_bytes > size:
                if (out := solve(held)) is not None:
                    yield out
                held, held_bytes = [], 0
            current = anchor
            held.append((doc, start, raw))
            held_bytes += len(raw)
    if held and (out := solve(held)) is not None:
        yield out
    tx.release()


def _strings(batches, min_len: int):
    """Every string of each context: (h, g: its 128-bit hash, doc, start)."""
    values, other = tx.byte_values(False, 23), tx.byte_values(False, 24)
    for batch in batches:
        ids, starts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        for a, b, data, offsets in tx.text_blocks(batch.column(3)):
            count = np.maximum(np.diff(offsets) - min_len + 1, 0)
            which = np.repeat(np.arange(b - a), count)
            shift = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            s = offsets[:-1][which] + shift
            yield pa.RecordBatch.from_arrays([pa.array(tx.as_long(tx.span_hashes(data, s, s + min_len, v))) for v in (values, other)] + [pa.array(ids[a:b][which]), pa.array(starts[a:b][which] + shift)], names=["h", "g", "doc", "start"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc, start, stop): byte ranges covered by repeats, overlapping ones included."""
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    scan = named.mapInArrow(lambda it: _emit_anchors(it, min_len, gram), SCAN)
    same = W.partitionBy("anchor", "context").orderBy("doc", "at")
    around = W.partitionBy("anchor")
    # known repeats pass through as anchors of their own
    judged = (scan.repartition("anchor").withColumn("first", F.first(F.struct("doc", F.shiftright("at", 24).alias("p"))).over(same))
              .withColumn("nth", F.row_number().over(same))
              .withColumn("contexts", F.sum((F.col("nth") == 1).cast("long")).over(around)))
    known = F.col("kind") == _COVER
    again = known | (F.col("first.doc") != F.col("doc")) | (F.col("first.p") != F.shiftright("at", 24))
    judged = judged.select("doc", "anchor", "contexts", again.alias("again"), F.when(known, F.col("at")).otherwise(_start(F.col("at"))).alias("start"),
                           F.when(known, F.col("context")).otherwise(_stop(F.col("at"), min_len)).alias("stop"))
    judged, _ = materialize(judged.where("again OR contexts > 1"))
    whole = judged.where("again").select("doc", "start", "stop")
    sources = judged.where("NOT again")
    per_doc = sources.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "stop", (F.col("contexts") > hot).alias("hot"))).alias("sources"))
    texts = named.join(per_doc, "doc").select("doc", "text", "sources")
    contexts, _ = materialize(texts.mapInArrow(lambda it: _contexts(it, min_len), "doc long, anchor long, start long, bytes binary, is_hot boolean"))
    cold = contexts.where("NOT is_hot").repartition("anchor").sortWithinPartitions("anchor", "doc", "start")
    found = cold.select("anchor", "doc", "start", "bytes").mapInArrow(lambda it: _array_repeats(it, min_len, ARRAY_BYTES), "doc long, start long, stop long")
    strings = contexts.where("is_hot").select("doc", "anchor", "start", "bytes").mapInArrow(lambda it: _strings(it, min_len), "h long, g long, doc long, start long")
    earliest = strings.groupBy("h", "g").agg(F.min(F.struct("doc", "start")).alias("e"), F.count("*").alias("n")).where("n > 1").select("h", "g", "e")
    single = strings.join(earliest, ["h", "g"]).where("e.doc <> doc OR e.start <> start").select("doc", "start", (F.col("start") + min_len).alias("stop"))
    return whole.union(found).union(single)


def _remove(batches, n_in: int):
    """(columns, text, spans) -> columns, the remaining bytes' digest, counts and the maximal removed runs."""
    for batch in tx.small_batches(batches):
        kept, sizes, removed, runs, digests = [], [], [], [], []
        for text, spans in zip(batch.column(n_in).to_pylist(), batch.column(n_in + 1).to_pylist()):
            raw = (text or "").encode()
            merged: list[list[int]] = []
            for s in sorted((x["start"], x["stop"]) for x in spans or () if x["stop"] <= len(raw)):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            parts, at = [], 0
            for a, b in merged:
                parts.append(raw[at:a])
                at = b
            rest = b"".join([*parts, raw[at:]])
            kept.append(rest)
            sizes.append(len(raw))
            removed.append(len(raw) - len(rest))
            runs.append([{"start": a, "stop": b} for a, b in merged])
            digests.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:n_in], pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(digests, pa.string())],
            names=[f"c{i}" for i in range(n_in)] + ["kept", "n_bytes", "n_removed", "removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = MIN_LEN, keep: list[str] | None = None, **options) -> DataFrame:
    """Columns ``keep`` (all by default) as c0.., then kept (bytes), n_bytes, n_removed, removed (runs of bytes), kept_sha256."""
    names = docs.columns if keep is None else keep
    spans = repeated_spans(docs, id_col, text_col, min_len, **options).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{id_col}`").cast("long").alias("own_id"), F.col(f"`{text_col}`").alias("own_text"))
    both = plain.join(spans, F.col("own_id") == F.col("doc"), "left").select(*[f"c{i}" for i in range(len(names))], "own_text", "spans")
    n = len(names)
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in both.schema[:n]) + "kept binary, n_bytes long, n_removed long, removed array<struct<start:long,stop:long>>, kept_sha256 string"
    return both.mapInArrow(lambda it: _remove(it, n), schema)
