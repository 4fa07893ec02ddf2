"""Benchmark decontamination: size-partitioned MinHash containment search.

Which documents hold at least ``threshold`` of a benchmark item's distinct ``n``-word shingles?
Items are partitioned by size (number of shingles, powers of two).  An item's signature is its
``s`` smallest shingle hashes, rare shingles first; ``s`` depends on its partition's largest
size ``u``: an item may miss at most ``floor((1 - threshold) * u)`` shingles, so with twice
that many hashes plus one in the signature, a document that holds the item must hold most of
them.  This makes the search exact however much longer the document is.

1. Item shingles are counted, signed and written; a Bloom filter of bounded size is made of them.
2. One scan of the documents keeps the shingles that hit the filter, with their text.
3. Joining them to the signatures gives candidate (document, item) pairs.
4. Candidates are verified by exact containment, comparing the shingles' text.

Words are runs of characters outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased.  An item of fewer
than ``n`` words is one shingle of all its words and is looked for with that width.

Defined cases: null or empty text holds no shingle (such an item is never found); documents or
items without id are skipped by the search and stay in the corpus; repeated rows with one id
count as one; an empty documents or benchmark table gives no pairs; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import materialize
from . import bloom
from . import textops as tx

N, THRESHOLD = 5, 0.8
SCHEMA = "id long, width int, key long, shingle binary"


def _width_hashes(h: np.ndarray, row: np.ndarray, width: int):
    sh, at = tx.run_hashes(h, row, width)
    return tx.mix(sh ^ tx.U(width)), at


def _shingles(batches, n: int, widths, packed, bits: int):
    """Distinct shingles (id, width, key, text) of each text; of items every one, of documents those in the filter."""
    schema = pa.schema([("id", pa.int64()), ("width", pa.int32()), ("key", pa.int64()), ("shingle", pa.binary())])
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] = lower[97:123]
    lower[[9, 10, 11, 12, 13]] = 32
    values = tx.byte_values(True)
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in tx.text_blocks(batch.column(1)):
            s, e, row = tx.word_spans(data, offsets)
            if not len(s):
                continue
            h = tx.span_hashes(data, s, e, values)
            words = np.bincount(row, minlength=b - a)
            for width in widths or range(1, n + 1):
                key, at = _width_hashes(h, row, width)
                if packed is None and width < n:  # a short item is one shingle
                    own = words[row[at]] == width
                    key, at = key[own], at[own]
                elif packed is not None:
                    hit = bloom.contains(packed.value, key, bits)
                    key, at = key[hit], at[hit]
                if not len(key):
                    continue
                by = np.lexsort((key, row[at]))
                key, at = key[by], at[by]
                fresh = np.append(True, (key[1:] != key[:-1]) | (row[at][1:] != row[at][:-1]))
                key, at = key[fresh], at[fresh]
                raw = lower[data].tobytes()
                texts = [b" ".join(raw[x:y].split()) for x, y in zip(s[at].tolist(), e[at + width - 1].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b][row[at]]), pa.array(np.full(len(at), width, np.int32)),
                                                  pa.array(tx.as_long(key)), pa.array(texts, pa.binary())], schema=schema)


def item_shingles(benchmark: DataFrame, id_col: str, text_col: str, n: int, threshold: float) -> DataFrame:
    """(item, width, key, shingle, size, need, signed, rank): rank <= signed are the signature."""
    items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = items.mapInArrow(lambda it: _shingles(it, n, None, None, 0), SCHEMA).dropDuplicates(["id", "key", "shingle"])
    rows = rows.withColumn("size", F.count("*").over(W.partitionBy("id")))
    rows = rows.join(rows.groupBy("key", "shingle").agg(F.count("*").alias("held_by")), ["key", "shingle"])
    upper = F.pow(F.lit(2.0), F.floor(F.log2("size")) + 1) - 1
    missing = F.floor((1 - threshold) * upper + 1e-9)
    rank = F.row_number().over(W.partitionBy("id").orderBy("held_by", "key", "shingle"))
    return rows.select(F.col("id").alias("item"), "width", "key", "shingle", F.col("size").cast("long"),
                       F.ceil(threshold * F.col("size") - 1e-9).cast("long").alias("need"),
                       F.least(F.col("size"), 2 * missing + 1).cast("long").alias("signed"), rank.cast("long").alias("rank"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found): pairs whose containment reaches the threshold."""
    spark = docs.sparkSession
    items, _ = materialize(item_shingles(benchmark, item_col, item_text_col, n, threshold))
    about = items.agg(F.count("*").alias("n"), F.collect_set("width").alias("widths")).first()
    widths = sorted(about.widths)  # at most n of them
    bits = bloom.bits_for(about.n)
    packed = spark.sparkContext.broadcast(bloom.build(items.select("key"), bits))
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    scan = lambda it: _shingles(it, n, widths, packed, bits) if widths else iter(())
    hits, _ = materialize(named.mapInArrow(scan, SCHEMA).dropDuplicates(["id", "key", "shingle"]))
    signature = items.where("rank <= signed").select("item", "key", "shingle", "size", "need", "signed")
    # of its `signed` hashes at most size - need may be missing
    found = (hits.join(signature, ["key", "shingle"]).groupBy("id", "item", "size", "need", "signed").agg(F.count("*").alias("seen"))
             .where("seen >= greatest(1, signed - (size - need))").select(F.col("id").alias("doc"), "item", "size", "need"))
    candidates, _ = materialize(found)
    pairs = candidates.join(hits, F.col("doc") == F.col("id")).select("doc", "item", "size", "need", "key", "shingle")
    return (pairs.join(items.select("item", "key", "shingle"), ["item", "key", "shingle"]).groupBy("doc", "item", "size", "need").agg(F.count("*").alias("n_found"))
            .where("n_found >= need").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("size").alias("n_shingles"), "n_found"))


def decontamination_stage(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; same columns."""
    leaks = contaminated(docs, benchmark, id_col, **options).select(F.col("doc_id").alias("leaking_doc")).distinct()
    return docs.join(leaks, docs[id_col] == leaks["leaking_doc"], "left_anti")
