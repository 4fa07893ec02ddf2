"""Near-duplicate join: Jaccard similarity of word shingles by an LSH forest of MinHash.

1. Documents with the same words in the same order form a *class* (hashed, aggregated before
   any shuffle of texts); everything below works on one representative per class.
2. Each representative has ``TREES`` signatures of ``DEPTH`` MinHash values.  The rows of a tree
   sorted by signature are its prefix trie: a row's longest match is the longest prefix that it
   shares with a neighbour.  Rows whose longest match is shorter than ``SHALLOWEST`` in every
   tree are done.
3. A pair of similarity s has equal prefixes of length k in some tree with probability
   P(s) = 1 - (1 - s^k)^TREES.  The prefix length is the greatest of ``DEPTHS`` whose P at the
   threshold itself reaches the target (4 by default), so every link is found with at least that
   probability, whatever other links the table holds.
4. The rows with equal prefixes in a tree form a bucket; of buckets holding the same rows one is
   compared: its pairs exactly, on the shingle sets of their texts.  A pair is compared in the
   first tree where it matches.

Large buckets are cut into chunks, and each pair of chunks is one task group, so no group is
unbounded and no pairs are emitted: a group returns, per row, the number of its links and the
edges of a spanning forest.  Components are found by label propagation over those edges.

Words are runs of characters outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; a text of fewer
than ``n`` words has one shingle.

Defined cases: texts without words, and documents without id, have no links and are classes of
their own (class_id is the doc_id); rows that repeat an id with the same text are copies of one
class; an empty table gives an empty result; further columns are ignored by the join and kept
by the stage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import textops as tx

N, THRESHOLD = 5, 0.8
TREES, DEPTH, SHALLOWEST = 30, 6, 4
DEPTHS = (6, 5, 4)
#: of a pair at the threshold itself; prefixes of 4 miss one with probability 1.4e-7
TARGET_RECALL = 0.999999
#: rows of a bucket compared in one group (with as many of another chunk); a bucket of m rows
#: sends m * ceil(m / CHUNK) rows, and a group takes some 50 MB beside its texts
CHUNK = 1024


def _rows_hash(values: np.ndarray, row: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Order-dependent 64-bit hash of each row's run of values (rows without values: 0)."""
    first = np.searchsorted(row, np.arange(n))
    place = (np.arange(len(row)) - first[row]).astype(np.uint64)
    out = np.zeros(n, np.uint64)
    full = np.flatnonzero(np.bincount(row, minlength=n))
    if len(full):
        out[full] = np.add.reduceat(tx.mix(values ^ tx.mix(place + tx.U(seed))), first[full])
    return tx.mix(out ^ tx.U(seed))


def _identity(data, offsets):
    """Two independent 64-bit hashes of each text's sequence of words, and its number of words."""
    n = len(offsets) - 1
    s, e, row = tx.word_spans(data, offsets)
    h, g = tx.digests(data, s, e, True, 1, 2)
    return _rows_hash(h, row, n, 17), _rows_hash(g, row, n, 1 << 33), np.bincount(row, minlength=n)


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = tx.mix(np.arange(2 * n, dtype=np.uint64) + tx.U(0xABCDEF))
    return x[:n] | tx.U(1), x[n:]


def _sign(batches, n: int, trees: int, depth: int):
    """(doc, v, w, signature) of texts with words; v and w identify the class."""
    schema = pa.schema([("doc", pa.int64()), ("v", pa.int64()), ("w", pa.int64()), ("signature", pa.binary())])
    a, b = _multipliers(trees * depth)
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in tx.text_blocks(batch.column(1)):
            v, w, words = _identity(data, offsets)
            sh, row = tx.shingle_hashes(data, offsets, n)
            has = np.flatnonzero(words)
            if not len(has):
                continue
            first = np.searchsorted(row, has)
            mins = np.empty((len(has), trees * depth), ">u2")
            for i in range(trees * depth):
                # 16 bits of a 64-bit minimum
                mins[:, i] = tx.mix(np.minimum.reduceat(sh * a[i] + b[i], first)) >> tx.U(48)
            raw, width = mins.tobytes(), 2 * trees * depth
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[lo:hi][has]), pa.array(tx.as_long(v[has])), pa.array(tx.as_long(w[has])),
                 pa.array([raw[i * width:(i + 1) * width] for i in range(len(has))], pa.binary())], schema=schema)


def _explode_trees(batches, trees: int, depth: int):
    schema = pa.schema([("v", pa.int64()), ("tree", pa.int32()), ("prefix", pa.binary())])
    for batch in batches:
        n, width = batch.num_rows, 2 * depth
        if not n:
            continue
        raw = b"".join(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), trees)), pa.array(np.tile(np.arange(trees, dtype=np.int32), n)),
             pa.Array.from_buffers(pa.binary(width), n * trees, [None, pa.py_buffer(raw)]).cast(pa.binary())], schema=schema)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows."""
    return np.argmin(np.concatenate([a == b, np.zeros((len(a), 1), bool)], axis=1), axis=1)


def _longest_match(batches, depth: int, shallowest: int):
    """Rows sorted by (tree, prefix) -> those whose longest match is at least ``shallowest``, with it."""
    schema = pa.schema([("v", pa.int64()), ("tree", pa.int32()), ("prefix", pa.binary()), ("longest", pa.int32())])
    last = None  # the row whose next neighbour isn't known yet: v, tree, prefix, match before

    def out(v, tree, prefix, longest):
        keep = np.flatnonzero(longest >= shallowest)
        raw = prefix[keep].tobytes()
        return pa.RecordBatch.from_arrays([pa.array(v[keep]), pa.array(tree[keep]), pa.array([raw[i:i + 2 * depth] for i in range(0, len(raw), 2 * depth)], pa.binary()),
                                           pa.array(longest[keep].astype(np.int32))], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        v, tree = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        prefix = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, depth)
        if last is not None:
            v, tree, prefix = np.append(last[0], v), np.append(last[1], tree).astype(np.int32), np.concatenate([last[2], prefix])
        next_ = np.where(tree[1:] == tree[:-1], _common(prefix[1:], prefix[:-1]), 0)
        before = np.append(last[3] if last is not None else 0, next_)
        yield out(v[:-1], tree[:-1], prefix[:-1], np.maximum(before[:-1], next_))
        last = (v[-1:], tree[-1:], prefix[-1:].copy(), before[-1])
    if last is not None:
        yield out(last[0], last[1], last[2], np.array([last[3]]))


def _links_of(texts: list[str], open_: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and row of the pairs of ``open_`` that reach the threshold."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    parts = [tx.shingle_hashes(np.frombuffer(b"".join(raw[a:b]), np.uint8), offsets[a:b + 1] - offsets[a], n) + (a,) for a, b in tx.blocks(offsets)]
    sh = np.concatenate([p[0] for p in parts])
    row = np.concatenate([p[1] + p[2] for p in parts])
    by = np.lexsort((row, sh))
    sh, row = sh[by], row[by]
    fresh = np.append(True, (sh[1:] != sh[:-1]) | (row[1:] != row[:-1]))[: len(sh)]
    sh, row = sh[fresh], row[fresh]
    size = np.bincount(row, minlength=len(texts))
    new = np.append(True, sh[1:] != sh[:-1])[: len(sh)]
    count = np.diff(np.append(np.flatnonzero(new), len(sh)))
    shared = np.repeat(count > 1, count)  # shingles of one row only don't matter
    column = np.cumsum(shared & new) - 1
    row, column = row[shared], column[shared]
    inter = np.zeros((len(texts), len(texts)), np.float32)  # counts: exact below 2**24
    step = 4096 if len(texts) <= 512 else 1024
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [c, c + step])
        m = np.zeros((len(texts), step), np.float32)
        m[row[a:b], column[a:b] - c] = 1
        inter += m @ m.T
    # a little below the threshold in single precision, then exactly
    wide = size.astype(np.float32)
    i, j = np.nonzero(open_ & (inter > 0) & (inter >= np.float32(threshold - 1e-3) * (wide[:, None] + wide[None, :] - inter)))
    both = inter[i, j].astype(np.float64)
    union = size[i] + size[j] - both
    ok = both >= threshold * union - 1e-9
    return i[ok], j[ok]


LINK_SCHEMA = "kind string, a long, b long, n long"


def _compare(tree: int, side: np.ndarray, v: np.ndarray, copies: np.ndarray, signatures: list[bytes], texts: list[str],
             n: int, threshold: float, trees: int, depth: int, k: int) -> list[tuple]:
    """One group, a bucket's chunk or two of them (``side``): links per row, edges of a spanning forest."""
    sig = np.frombuffer(b"".join(signatures), np.uint16).reshape(len(v), trees, depth)
    open_ = np.zeros((len(v), len(v)), bool)
    open_[np.triu_indices(len(v), 1)] = True
    if side.any():
        open_ &= side[:, None] != side[None, :]
    # matched before: in an earlier tree
    for t in range(tree):
        if len(v) <= 64:
            open_ &= (sig[:, None, t, :k] != sig[None, :, t, :k]).any(axis=2)
        else:
            key = np.unique(np.ascontiguousarray(sig[:, t, :k]).view(np.dtype((np.void, 2 * k))).ravel(), return_inverse=True)[1]
            open_ &= key[:, None] != key[None, :]
    if not open_.any():
        return []
    i, j = _links_of(texts, open_, n, threshold)
    if not len(i):
        return []
    links = np.bincount(i, weights=copies[j], minlength=len(v)) + np.bincount(j, weights=copies[i], minlength=len(v))
    rows = [("links", int(v[x]), None, int(links[x])) for x in np.flatnonzero(links)]
    label = np.arange(len(v))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    return rows + [("edge", int(v[label[x]]), int(v[x]), None) for x in np.flatnonzero(label != np.arange(len(v)))]


def _compare_groups(batches, *how):
    """Rows sorted by group (tree, prefix, lo, hi), then chunk, v, copies, signature, text: the groups' results."""
    schema = pa.schema([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
    current, held, done = None, [], []

    def close():
        chunk, v, copies, signatures, texts = zip(*held)
        side = np.array([c == current[3] for c in chunk]) & (current[2] != current[3])
        done.extend(_compare(current[0], side, np.array(v, np.int64), np.array(copies, np.int64), signatures, texts, *how))

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
        done.clear()
        return batch

    for batch in batches:
        for tree, prefix, lo, hi, *row in zip(*(c.to_pylist() for c in batch.columns)):
            group = (tree, prefix, lo, hi)
            if group != current:
                if held:
                    close()
                current, held = group, []
            held.append(row)
        if done:
            yield out()
    if held:
        close()
    if done:
        yield out()


def estimated_recall(found: dict[float, int], depth: int, trees: int) -> float:
    """Share of links found at ``depth``, from the similarities (in hundredths) of those found."""
    seen = missed = 0.0
    for s, c in found.items():
        p = 1 - (1 - (s / 100) ** depth) ** trees
        seen += c
        missed += c * (1 - p) / p
    return seen / (seen + missed) if seen else 0.0


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex of each vertex's component, by label propagation with shortcuts."""
    both, _ = materialize(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    label, _ = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(label, F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near, F.col("v") == F.col("a")).select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = label.select(F.col("v").alias("x"), F.col("label").alias("of_x"))
        new, _ = materialize(step.join(jump, F.col("label") == F.col("x"), "left").select("v", "old", F.least("label", "of_x").alias("label")))
        label = new.select("v", "label")
        if new.where("label <> old").isEmpty():
            return label


class Forest:
    """The state of one join: classes, the tries' candidate rows, and links found so far."""

    def __init__(self, docs: DataFrame, n: int = N, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, shallowest: int = SHALLOWEST, chunk: int = CHUNK):
        self.n, self.threshold, self.trees, self.depth, self.shallowest, self.chunk = n, threshold, trees, depth, shallowest, chunk
        named = docs.where("id IS NOT NULL")
        self.signed, _ = materialize(named.mapInArrow(lambda it: _sign(it, n, trees, depth), "doc long, v long, w long, signature binary"))
        self.classes, _ = materialize(self.signed.groupBy("v", "w").agg(F.min("doc").alias("doc"), F.count("*").alias("copies"), F.min("signature").alias("signature")))
        rows = self.classes.select("v", "signature").mapInArrow(lambda it: _explode_trees(it, trees, depth), "v long, tree int, prefix binary")
        tries = (rows.repartition("tree", F.substring("prefix", 1, 2 * shallowest)).sortWithinPartitions("tree", "prefix", "v")
                 .mapInArrow(lambda it: _longest_match(it, depth, shallowest), "v long, tree int, prefix binary, longest int"))
        self.rows, _ = materialize(tries)
        # texts of the representatives that match anything, fetched once
        wanted = self.rows.select("v").distinct().join(self.classes, "v")
        texts = wanted.join(named.select("id", "text"), F.col("doc") == F.col("id")).select("text", "doc", "v", "w", "copies", "signature")
        tagged = texts.mapInArrow(self._keep_own, "v long, copies long, signature binary, text string")
        self.texts, _ = materialize(tagged.dropDuplicates(["v"]) if self._repeated_ids(named) else tagged)

    @staticmethod
    def _keep_own(batches):
        """Where an id has several texts, only the row with the representative's text."""
        for batch in batches:
            v, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi, data, offsets in tx.text_blocks(batch.column(0)):
                own = _identity(data, offsets)
                keep[lo:hi] = (tx.as_long(own[0]) == v[lo:hi]) & (tx.as_long(own[1]) == w[lo:hi])
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([kept.column(2), kept.column(4), kept.column(5), kept.column(0)], names=["v", "copies", "signature", "text"])

    @staticmethod
    def _repeated_ids(named: DataFrame) -> bool:
        return not named.groupBy("id").count().where("count > 1").isEmpty()

    def links_at(self, k: int) -> DataFrame:
        """Compare the pairs that match at depth ``k``."""
        n, threshold, trees, depth, chunk = self.n, self.threshold, self.trees, self.depth, self.chunk
        at = self.rows.where(F.col("longest") >= k).select("v", "tree", F.substring("prefix", 1, 2 * k).alias("prefix"))
        buckets = at.groupBy("tree", "prefix").agg(F.count("*").alias("size"), F.sum(F.xxhash64("v").cast("decimal(30,0)")).alias("s"), F.bit_xor(F.xxhash64("v", F.lit(1))).alias("x"))
        # of buckets with the same rows the first tree's
        first, _ = materialize(buckets.groupBy("size", "s", "x").agg(F.min(F.struct("tree", "prefix")).alias("bucket")))
        chosen = first.select(F.col("bucket.tree").alias("tree"), F.col("bucket.prefix").alias("prefix"), F.ceil(F.col("size") / chunk).cast("int").alias("chunks"))
        members = at.join(chosen, ["tree", "prefix"]).withColumn("chunk", F.pmod(F.xxhash64("v", F.lit(2)), F.col("chunks")).cast("int"))
        cells = (members.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
                 .select("v", "tree", "prefix", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi")))
        full = cells.join(self.texts, "v")
        dealt = full.repartition("tree", "prefix", "lo", "hi").sortWithinPartitions("tree", "prefix", "lo", "hi", "chunk", "v")
        return dealt.select("tree", "prefix", "lo", "hi", "chunk", "v", "copies", "signature", "text").mapInArrow(
            lambda it: _compare_groups(it, n, threshold, trees, depth, k), LINK_SCHEMA)

    def run(self, target: float = TARGET_RECALL, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
        """All link rows, at the longest prefixes that find a link at the threshold itself with probability ``target``."""
        enough = [k for k in depths if estimated_recall({100 * self.threshold: 1}, k, self.trees) >= target]
        return materialize(self.links_at(max(enough) if enough else min(depths)))[0]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: float = TARGET_RECALL, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of its component), n_links (other rows at the threshold or above), n_copies (rows with the same words)."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    forest = Forest(named, **options)
    links = forest.run(target)
    counts = links.where("kind = 'links'").groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("links"))
    label = components(links.where("kind = 'edge'").select("a", "b"))
    of_class = (forest.classes.select("v", "w", F.col("doc").alias("first"), "copies").join(counts, "v", "left").join(label, "v", "left")
                .withColumn("label", F.coalesce("label", "v")))
    smallest = of_class.groupBy(F.col("label").alias("l")).agg(F.min("first").alias("class_id"))
    of_class = of_class.join(smallest, F.col("label") == F.col("l"))
    of_class, _ = materialize(of_class.select(F.col("v").alias("cv"), F.col("w").alias("cw"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies")))
    with_words = forest.signed.select("doc", "v", "w").join(of_class, (F.col("v") == F.col("cv")) & (F.col("w") == F.col("cw")))
    rest = named.where(F.col("id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return with_words.select(F.col("doc").alias("doc_id"), "class_id", "n_links", "n_copies").unionByName(
        rest.select(F.col("id").alias("doc_id"), F.col("id").alias("class_id"), none.alias("n_links"), one.alias("n_copies")))


def near_duplicate_stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document (the smallest doc_id) of each class; same columns."""
    gone = near_duplicates(docs, id_col, text_col, **options).where("class_id <> doc_id").select(F.col("doc_id").alias("duplicate_doc")).distinct()
    return docs.join(gone, docs[id_col] == gone["duplicate_doc"], "left_anti")
