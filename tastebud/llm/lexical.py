"""Ranked lexical search: range-maximum tables per posting list, best-first over document intervals.

Scores are integers (BM25-like): a term's weight ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, a
document's length norm ``m = 50 + (50 n N) div L``, and a document's score for an item the sum over
the item's distinct terms of ``w * ((10**9 tf) div (1000 tf + 20 m))``.

1. Documents are scanned once; of each only its length and its postings for the items' terms are
   written (128-bit hashes of the terms against the sorted vocabulary).  Document frequencies and
   lengths are summed from that table.
2. Each task reads its part of that table in blocks of documents ordered by doc_id.  A block's
   posting lists (documents and their impacts) lie end to end, with one sparse table of positions of
   range maxima over them: two look-ups give the greatest impact of a term in a document interval.
3. An item's search starts from the whole block.  The sum of its terms' range maxima bounds every
   score in an interval; intervals are taken best bound first and split at the document of greatest
   impact, which is scored exactly; short ones are scored whole.  It ends when no bound can reach the
   ``k``-th best, which the task's blocks share.  The best of all tasks are ranked per item.

No document moves between tasks: only each task's ``k`` best per item do.  Items beyond
``MAX_ITEM_TERMS`` (item, term) pairs are searched slice by slice, so what is sent to the tasks is
bounded; nothing is left out.

Terms are the maximal runs of ASCII letters and digits and of characters above U+007F, with A-Z
lower-cased only.  Defined cases: null and termless texts have no terms and are no documents of the
statistics; documents without id count in the statistics and aren't ranked; rows that repeat a
doc_id are ranked one by one; rows that repeat an item_id are one item with all their terms, items
without id or terms have no result; further columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import textops as tx

K = 50
#: (item, term) pairs of one pass: about 30 MB in the driver and each task
MAX_ITEM_TERMS = 500_000
#: postings of a block: its table takes about 4 bytes for each and each doubling of the longest list
BLOCK_POSTINGS = 1_000_000
#: intervals taken at once, and postings up to which an interval is scored whole
AT_ONCE, SHORT = 256, 192
_BETWEEN = np.ones(256, bool)
_BETWEEN[128:] = _BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = False


def _item_terms(batches):
    """(item, term) of each item text, with repeats."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in tx.text_blocks(batch.column(1)):
            s, e, row = tx.word_spans(data, offsets, _BETWEEN)
            raw = lower[data].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(ids[a:b][row], pa.int64()), pa.array([raw[x:y] for x, y in zip(s.tolist(), e.tolist())], pa.binary())], names=["item", "term"])


class Vocabulary:
    """The items' distinct terms by hash; a second hash must agree."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        h, g = tx.digests(data, ends - np.array([len(t) for t in terms], np.int64), ends, True, 31, 32)
        self.order = np.argsort(h)  # sorted place -> term number
        self.h, self.g = h[self.order], g[self.order]

    def find(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Places among ``starts`` that hold a term, and the term's number."""
        if not len(self.h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h, = tx.digests(data, starts, ends, True, 31)
        at = np.searchsorted(self.h, h)
        at[at == len(self.h)] = 0
        hit = np.flatnonzero(self.h[at] == h)
        g, = tx.digests(data, starts[hit], ends[hit], True, 32)
        same = self.g[at[hit]] == g
        return hit[same], self.order[at[hit[same]]]


def _postings(batches, shared):
    """(doc_id, n, terms, tfs) of each text: its length in terms and its counts of the vocabulary's terms."""
    vocabulary = shared.value
    size = max(len(vocabulary.h), 1)
    for batch in batches:
        for a, b, data, offsets in tx.text_blocks(batch.column(1)):
            s, e, row = tx.word_spans(data, offsets, _BETWEEN)
            hit, term = vocabulary.find(data, s, e)
            key, tf = np.unique(row[hit] * size + term, return_counts=True)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(key // size, minlength=b - a))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.bincount(row, minlength=b - a).astype(np.int64)),
                 pa.ListArray.from_arrays(cuts, pa.array((key % size).astype(np.int32))), pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int64)))],
                names=["doc_id", "n", "terms", "tfs"])


def _frequencies(batches, size: int):
    """(term, df) of one task."""
    df = np.zeros(size, np.int64)
    for batch in batches:
        df += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
    has = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(df[has])], names=["term", "df"])


class Block:
    """Posting lists of some documents, ordered by doc_id, and the sparse table over their impacts."""

    def __init__(self, ids, n, counts, terms, tfs, weights, n_docs: int, n_terms: int):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.size = ids[order], len(ids)
        row = np.repeat(np.arange(len(ids)), counts)
        m = 50 + (50 * n[row] * n_docs) // n_terms
        impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m))
        key = terms.astype(np.int64) * self.size + place[row]
        by = np.argsort(key, kind="stable")
        self.key, self.impact = key[by], impact[by]
        self.doc = place[row][by]
        self.first = np.searchsorted(self.key, np.arange(len(weights) + 1, dtype=np.int64) * self.size)
        longest = int(np.diff(self.first).max(initial=1))
        best = [np.arange(len(key), dtype=np.int32)]
        while 2 << (len(best) - 1) <= longest:
            half = 1 << (len(best) - 1)
            before, after = best[-1][:-half], best[-1][half:]
            best.append(np.where(self.impact[after] > self.impact[before], after, before))
        # all levels end to end: level l is a position and 2**l - 1 fewer entries than the postings
        self.level_at = np.concatenate([[0], np.cumsum([len(x) for x in best])])[:-1]
        self.best = np.concatenate(best)
        self.log = np.zeros(longest + 1, np.int64)
        for i in range(1, len(best)):
            self.log[1 << i:] = i

    def most(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position and value of the greatest impact in each ``[a, b)``; value 0 where it is empty."""
        full = b > a
        level = self.log[np.where(full, b - a, 1)]
        at = self.level_at[level]
        x = self.best[np.where(full, at + a, 0)]
        y = self.best[np.where(full, at + b - (np.int64(1) << level), 0)]
        position = np.where(self.impact[y] > self.impact[x], y, x)
        return position, np.where(full, self.impact[position], 0)

    def search(self, terms: np.ndarray, k: int, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` best of this block and of those given (best first), and the number of intervals opened."""
        terms = terms[self.first[terms + 1] > self.first[terms]]
        a, b = self.first[terms][None, :], self.first[terms + 1][None, :]
        bound = self.most(a, b)[1].sum(axis=1)
        low = np.zeros(1, np.int64)  # first document of each interval
        opened = 0
        while True:
            live = bound > 0
            if len(scores) == k:
                live &= (bound > scores[-1]) | ((bound == scores[-1]) & (self.ids[np.minimum(low, self.size - 1)] <= ids[-1]))
            a, b, bound, low = a[live], b[live], bound[live], low[live]
            if not len(bound):
                return scores, ids, opened
            take = np.ones(len(bound), bool) if len(bound) <= AT_ONCE else np.zeros(len(bound), bool)
            if len(bound) > AT_ONCE:
                take[np.argpartition(bound, len(bound) - AT_ONCE)[-AT_ONCE:]] = True
            opened += int(take.sum())
            short = take & ((b - a).sum(axis=1) <= SHORT)
            found_docs, found_scores = self._whole(a[short], b[short])
            split = take & ~short
            a1, b1 = a[split], b[split]
            parts = [(a[~take], b[~take], bound[~take], low[~take])]
            if len(a1):
                position, value = self.most(a1, b1)
                at = self.doc[position[np.arange(len(a1)), value.argmax(axis=1)]]
                wanted = terms[None, :] * self.size + at[:, None]
                p = np.searchsorted(self.key, wanted)
                has = self.key[np.minimum(p, len(self.key) - 1)] == wanted
                found_docs = np.concatenate([found_docs, at])
                found_scores = np.concatenate([found_scores, np.where(has, self.impact[np.minimum(p, len(self.key) - 1)], 0).sum(axis=1)])
                for x, y, from_ in ((a1, p, low[split]), (p + has, b1, at + 1)):
                    parts.append((x, y, self.most(x, y)[1].sum(axis=1), from_))
            a, b, bound, low = (np.concatenate(x) for x in zip(*parts))
            scores, ids = best_of(np.concatenate([scores, found_scores]), np.concatenate([ids, self.ids[found_docs]]), k)

    def _whole(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the intervals and their scores."""
        size = (b - a).ravel()
        if not size.sum():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        stop = np.cumsum(size)
        position = np.repeat(a.ravel() - (stop - size), size) + np.arange(int(stop[-1]))
        doc = self.doc[position]
        by = np.argsort(doc, kind="stable")
        doc = doc[by]
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        return doc[first], np.add.reduceat(self.impact[position][by], first)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores above 0, best first, equal ones by id."""
    if len(scores) > 4 * k:  # what can't be among them goes before the sort
        high = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[high], ids[high]
    order = np.lexsort((ids, -scores))[:k]
    order = order[scores[order] > 0]
    return scores[order], ids[order]


def _search(batches, shared, k: int, block_postings: int):
    """Postings in any order -> (item_id, doc_id, score): the task's best of each item."""
    items, cuts, terms, weights, n_docs, n_terms = shared.value
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
    held, waiting = [], 0

    def close():
        ids, n, counts, t, tf = (np.concatenate(x) for x in zip(*held))
        block = Block(ids, n, counts, t, tf, weights, n_docs, n_terms)
        for i in range(len(items)):
            best[i] = block.search(terms[cuts[i]: cuts[i + 1]], k, *best[i])[:2]

    for batch in batches:
        ids, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        counts = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(counts)])
        t, tf = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
        row = 0
        while row < len(ids):
            end = max(row + 1, int(np.searchsorted(start, start[row] + block_postings - waiting, side="right")) - 1)
            held.append((ids[row:end], n[row:end], counts[row:end], t[start[row]: start[end]], tf[start[row]: start[end]]))
            waiting += int(start[end] - start[row])
            row = end
            if waiting >= block_postings or row < len(ids):
                close()
                held, waiting = [], 0
    if waiting:
        close()
    tx.release()
    size = np.array([len(s) for s, _ in best], np.int64)
    if size.sum():
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(items, size)), pa.array(np.concatenate([i for _, i in best])), pa.array(np.concatenate([s for s, _ in best]))],
                                         names=["item_id", "doc_id", "score"])


def _rank_slice(docs: DataFrame, pairs: DataFrame, k: int, block_postings: int) -> DataFrame:
    """(item_id, doc_id, score): each task's best for the items of ``pairs`` (item, term), at most ``MAX_ITEM_TERMS`` of them or one item's."""
    spark = docs.sparkSession
    t = pairs.toArrow()
    names, numbers = np.unique(np.array(t.column("term").to_pylist(), object), return_inverse=True)
    item = t.column("item").to_numpy()
    order = np.lexsort((numbers, item))
    items, first = np.unique(item[order], return_index=True)
    cuts, terms = np.append(first, len(order)), numbers[order].astype(np.int64)
    shared = spark.sparkContext.broadcast(Vocabulary(list(names)))
    postings, _ = materialize(docs.mapInArrow(lambda it: _postings(it, shared), "doc_id long, n long, terms array<int>, tfs array<long>"))
    shared.destroy()
    about = postings.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    size = len(names)
    df = postings.select("terms").mapInArrow(lambda it: _frequencies(it, size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    weights = np.zeros(size, np.int64)
    weights[df.column("term").to_numpy()] = np.floor(1000 * np.log((2 * (about.docs or 0) + 2) / (2 * df.column("df").to_numpy() + 1))).astype(np.int64)
    search = spark.sparkContext.broadcast((items, cuts, terms, weights, about.docs or 0, max(about.terms or 0, 1)))
    named = postings.where("doc_id IS NOT NULL AND size(terms) > 0")
    return named.mapInArrow(lambda it: _search(it, search, k, block_postings), "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", k: int = K, max_item_terms: int = MAX_ITEM_TERMS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item."""
    named = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long"), F.col(item_text_col).cast("string"))
    pairs, _ = materialize(named.mapInArrow(_item_terms, "item long, term binary").distinct())
    slices = -(-pairs.count() // max_item_terms)
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    found = None
    for i in range(max(slices, 1)):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == i) if slices > 1 else pairs
        part = _rank_slice(texts, own, k, block_postings)
        if slices > 1:
            part, _ = materialize(part)
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
