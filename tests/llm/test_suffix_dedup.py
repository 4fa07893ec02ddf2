import hashlib
import random

import numpy as np
import pytest
from conftest import SF

from tastebud.llm import queries, suffix_dedup as sd


def brute_order(b, depth):
    return sorted(range(len(b)), key=lambda i: (b[i:] + b"\xff" * depth)[:depth])


def random_bytes(rnd, n, alphabet):
    return bytes(rnd.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("seed", range(30))
def test_two_stage_order_and_common_prefixes(seed):
    rnd = random.Random(seed)
    alphabet = [b"ab", b"abcdefgh ", bytes(range(0, 256, 5)), b"a", b"ab\xff"][seed % 5]
    b = random_bytes(rnd, rnd.choice([1, 2, 3, 30, 300, 900]), alphabet)
    if seed % 3 == 0:
        b = (b[: len(b) // 3 + 1] * 4)[:1000]
    text = np.frombuffer(b, np.uint8)
    depth = 24
    order = sd.suffix_order(text, depth)
    assert sorted(order) == list(range(len(b)))
    cut = lambda i: (b[i:] + b"\xff" * depth)[:depth]
    assert [cut(i) for i in order] == [cut(i) for i in brute_order(b, depth)]
    shared = sd.common_prefixes(text, order, depth)
    for k in range(1, len(b)):
        x, y = b[order[k - 1]:], b[order[k]:]
        n = 0
        while n < min(len(x), len(y), depth) and x[n] == y[n]:
            n += 1
        if n < min(len(x), len(y)):
            assert shared[k] == n
        else:
            assert shared[k] >= n


def brute(rows, min_len):
    seen = {}
    docs = {}
    for d, t in rows:
        b = (t or "").encode()
        docs.setdefault(d, []).append(b)
        if d is not None:
            for i in range(len(b) - min_len + 1):
                s = b[i:i + min_len]
                seen[s] = min(seen.get(s, (d, i)), (d, i))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        if d is not None:
            for i in range(len(b) - min_len + 1):
                if seen[b[i:i + min_len]] < (d, i):
                    gone[i:i + min_len] = True
        runs = int(np.sum(gone[:-1] & ~np.append(False, gone[:-2]))) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, min_len=100, parts=4, **options):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, start string, anchor int").repartition(parts)
    got = sd.remove_repeats(df, min_len=min_len, keep=["doc_id"], **options).collect()
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in got)
    return sorted(((r.c0, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in got), key=str)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(rnd.randint(5, 60)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = " ".join(rnd.choice([text(rnd.randint(1, 30)), rnd.choice(passages)]) for _ in range(rnd.randint(1, 5)))
        if rows and rnd.random() < 0.3:
            t = rnd.choice(rows)[1] or ""
            k = rnd.randint(0, len(t))
            t = rnd.choice([t, t[:k] + "!" + t[k:], t[k:] + t[:k], t + t])
        rows.append((i * 7 % n, t))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows, parts=1 + seed * 2) == brute(rows, 100)


def test_hot_anchors_are_cut_up(spark):
    rows = corpus(77)
    assert run(spark, rows, hot=1) == run(spark, rows, hot=3) == brute(rows, 100)


def test_small_arrays_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(sd, "ARRAY_BYTES", 500)
    rows = corpus(5)
    assert run(spark, rows) == brute(rows, 100)


def test_defined_cases(spark):
    long = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(4000))
    rows = [(1, None), (2, ""), (3, "a" * 99), (4, "a" * 100), (5, "a" * 350), (6, "b" + "a" * 250), (7, long), (8, long), (8, long), (None, long), (9, long[:99]), (10, "x" + long[1:101]),
            (11, "ab" * 300), (12, "ba" * 300), (0, long[500:700] + "é" * 80 + long[500:650]), (13, "\x00" * 300), (14, "é" * 51)]
    got, want = run(spark, rows), brute(rows, 100)
    assert got == want


def test_text_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(sd, "SCAN_BYTES", 700)
    rows = corpus(9, 12)
    rows += [(100, " ".join(t for _, t in rows)), (101, " ".join(t for _, t in rows[::-1]))]
    assert run(spark, rows) == brute(rows, 100)


def test_every_start_has_one_anchor():
    rnd = random.Random(2)
    raw = [random_bytes(rnd, n, b"abc \n") for n in (0, 99, 100, 101, 500, 3000)]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    row, at, lo, hi, _ = sd.anchors(data, offsets, 100, 32)
    owned = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)])
    assert sorted(owned) == [i for r in range(len(raw)) for i in range(offsets[r], offsets[r + 1] - 99)]
    assert all(a <= p and p + 32 <= a + 100 and b <= p for a, b, p in zip(lo, hi, at))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op1_suffix_array_dedup(spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 100)
