import random
import zlib

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tastebud.llm import bpe, packing, queries

ODD_TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "x \nNext", "x\n\n  y", "don't we'll 'tis it's's", "wo'rd.'s ''s",
    "abc123def 4a5 -x- a_b (c) 'q' \"q\"", "tab\there\r\nline", "é è ñandú straße", "a b   c", " x  y", "x\x00y \x1cz \x1f q",
    "日本語 テキスト 。", "emoji 👍🏽 ok", "a <|endoftext|> b", "<|endoftext|>", "...!!! ??", "a.b,c;d", "x\x85y", "　z", "ﬁ ½ ² ٣ ४", "   lead", "trail   ",
    "AKIAABCDEFGHIJKL token=\"x\"", "á ë", "Ⅷ ⅷ", "'s", " 's", "1's 2't", "a\n'll"]


def reference_ids(path, text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def brute_pieces(path, doc_id, text, capacity=1024):
    ids = reference_ids(path, text) + [2]
    head = len(ids) % capacity or capacity
    cuts = [0, *range(head, len(ids) + 1, capacity)]
    return [(doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def test_parts_give_the_tokenizers_ids():
    rnd = random.Random(5)
    alphabet = list(" \n\t.,'\"!-_()0123aAbBzZéñ  日\x1c\x85²s t") + [" 's", "'ll", "  ", "\r\n"]
    texts = ODD_TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    path = queries.tokenizer_path()
    table = bpe.PartTable(path)
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ids, count = table.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    at = np.concatenate([[0], np.cumsum(count)])
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def check_layout(rows, capacity=1024):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_against_brute_force(spark):
    rows = queries.op3_best_fit_packing(spark, SF).collect()
    path = queries.tokenizer_path()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(p for d in docs for p in brute_pieces(path, d.doc_id, d.text))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    used = check_layout(rows)
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.02 + 1


def test_odd_texts_nulls_repeats_and_clashing_columns(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD_TEXTS)] + [(900, None, None, None), (901, "word " * 9000, "y", 2), (901, "word " * 9000, "y", 2), (None, "no id", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string, rank int")
    path = queries.tokenizer_path()
    got = packing.pack_documents(df, path).collect()
    want = [p for d, t, *_ in rows for p in brute_pieces(path, d, t)]
    key = lambda p: (p[0] is None, p)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    check_layout(got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, queries.tokenizer_path()).count() == 0


def test_kept_ids_make_the_sequences(spark):
    df = spark.createDataFrame([(i, "some words here " * (i % 7)) for i in range(60)], "doc_id long, text string")
    placed = packing.pack_documents(df, queries.tokenizer_path(), capacity=64, keep_ids=True)
    seqs = {r.sequence_id: r for r in packing.packed_sequences(placed).collect()}
    for r in placed.collect():
        s = np.frombuffer(bytes(seqs[r.sequence_id].ids), "<u4")
        assert zlib.crc32(s[r.offset:r.offset + r.length].tobytes()) == r.ids_crc32
    assert all(len(s.ids) == 4 * s.n_tokens <= 256 for s in seqs.values())


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_is_near_the_bound(seed):
    rnd = random.Random(seed)
    counts = {}
    for _ in range(rnd.randint(1, 60)):
        counts[rnd.randint(1, 100)] = rnd.randint(1, 50)
    plan = packing.plan_packing(counts, 100)
    used = {}
    for times, filling in plan:
        assert sum(filling) <= 100 and times > 0
        for x in filling:
            used[x] = used.get(x, 0) + times
    assert used == counts
    assert sum(t for t, _ in plan) <= sum(t for t, _ in packing._best_fit(np.array([counts.get(i, 0) for i in range(101)]), 100))


def brute_fewest(pieces, capacity):
    best = len(pieces)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(pieces):
            best = len(bins)
            return
        for j in {b: k for k, b in enumerate(bins)}.values():
            if bins[j] + pieces[i] <= capacity:
                go(i + 1, [*bins[:j], bins[j] + pieces[i], *bins[j + 1:]])
        go(i + 1, [*bins, pieces[i]])
    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_small_plans_are_optimal(seed):
    rnd = random.Random(seed)
    pieces = sorted((rnd.randint(15, 60) for _ in range(11)), reverse=True)
    counts = {x: pieces.count(x) for x in pieces}
    assert sum(t for t, _ in packing.plan_packing(counts, 100)) == brute_fewest(pieces, 100)


def test_hot_length_is_numbered_in_cells(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ROWS", 50)
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id") % 300 + 1).cast("int").alias("length"))
    check_layout(packing.assign_places(df).collect())


def test_structured_runs_keep_their_own_ids():
    from tests_runs import complements
    path = queries.tokenizer_path()
    for size in (1024, 2048, 4096):
        texts = complements(size)
        raw = [t.encode() for t in texts]
        ids, count = bpe.PartTable(path).encode(np.frombuffer(b"".join(raw), np.uint8), np.array([0, size, 2 * size]))
        want = [reference_ids(path, t) for t in texts]
        assert ids.tolist() == want[0] + want[1] and count.tolist() == [len(x) for x in want]


def test_parts_under_one_hash_go_through_the_library(monkeypatch):
    path = queries.tokenizer_path()
    whole = bpe.tx.digests
    monkeypatch.setattr(bpe.tx, "digests", lambda d, s, e, low, *seeds: [x % np.uint64(5) if i == 0 else x for i, x in enumerate(whole(d, s, e, low, *seeds))])
    text = "many different words here, all under five hashes"
    ids, _ = bpe.PartTable(path).encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    assert ids.tolist() == reference_ids(path, text)
