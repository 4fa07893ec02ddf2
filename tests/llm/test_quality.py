import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF

from tastebud.llm import quality, queries

WORD = r"[^\x20\x09-\x0D]+"


def base(t):
    t = t or ""
    w = re.findall(WORD, t)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    repeated = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated), failed)


def kneser_ney(texts, order):
    """p[gram] of the highest order, by the textbook."""
    grams = [Counter()]
    for t in texts:
        b = b"\xff" * (order - 1) + t.encode()
        grams[0].update(b[i:i + order] for i in range(len(b) - order + 1))
    for k in range(order - 1, 0, -1):
        grams.append(Counter(g[1:] for g in grams[-1]))
    p = None
    for k, c in enumerate(reversed(grams), start=1):
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        cut = {i: max(0.0, i - (i + 1) * y * n[i + 1] / n[i]) if n[i] and n[1] else 0.5 for i in (1, 2, 3)}
        total, saved = defaultdict(float), defaultdict(float)
        for g, x in c.items():
            total[g[:-1]] += x
            saved[g[:-1]] += min(x, cut[min(x, 3)])
        p = {g: (x - min(x, cut[min(x, 3)])) / total[g[:-1]] + saved[g[:-1]] / total[g[:-1]] * (p[g[1:]] if p else 1 / 256) for g, x in c.items()}
    return p


def corpus(seed, n=80):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(["en", "fr", None])
        syllables = ["the", "and", "re", "th"] if lang == "en" else ["eau", "é", "le", "la"]
        word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
        line = lambda: " ".join(word() for _ in range(rnd.randint(1, 12)))
        lines = [line() for _ in range(rnd.randint(0, 8))]
        rows.append((i, lang, "\n".join(lines + lines[: rnd.randint(0, 3)] + [""] * rnd.randint(0, 2)) + rnd.choice(["", "#$% <x>"])))
    return rows + [(900, "en", None), (901, None, ""), (None, "fr", "no id " * 30), (902, "de", "only one of its language " * 9), (902, "de", "only one of its language " * 9), (903, "fr", " \n\x0b\t"), (904, "fr", "a" * 100_000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, lang string, text string, n long, kept string").repartition(3)


def test_base_rules(spark):
    rows = corpus(1)
    got = quality.quality_verdicts(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == sorted(((d, *base(t)) for d, _, t in rows), key=str)
    assert not any(r.kept and r.base_failed for r in got)


@pytest.mark.parametrize("order", [1, 2, 5])
def test_model_against_the_textbook(spark, order):
    rows = corpus(2)
    model = defaultdict(dict)
    for r in quality.kneser_ney(quality.ngram_counts(frame(spark, rows), order=order), order).collect():
        model[r.lang][r.gram.to_bytes(order, "big")] = r.p
    for lang in ("en", "fr", ""):
        want = kneser_ney([t or "" for _, x, t in rows if (x or "") == lang], order)
        assert model[lang].keys() == want.keys()
        assert all(math.isclose(model[lang][g], p, rel_tol=1e-9) for g, p in want.items())


def test_probabilities_of_a_context_sum_to_at_most_one(spark):
    total = defaultdict(float)
    for r in quality.kneser_ney(quality.ngram_counts(frame(spark, corpus(3)), order=3), 3).collect():
        total[r.lang, r.gram >> 8] += r.p
    assert max(total.values()) <= 1 + 1e-9


def test_scores_and_both_ways_of_scoring(spark):
    rows = corpus(4)
    got = {(r.doc_id, r.lang, r.n_bytes): r for r in quality.quality_verdicts(frame(spark, rows)).collect()}
    joined = {(r.doc_id, r.lang, r.n_bytes): r for r in quality.quality_verdicts(frame(spark, rows), max_entries=0).collect()}
    assert got.keys() == joined.keys()
    for k, r in got.items():
        assert math.isclose(r.log_prob, joined[k].log_prob, rel_tol=1e-5, abs_tol=1e-5)
        assert (r.kept, r.n_words, r.base_failed) == (joined[k].kept, joined[k].n_words, joined[k].base_failed)
    p = kneser_ney([t or "" for _, x, t in rows if x == "en"], 5)
    for d, lang, t in rows:
        if lang == "en" and t:
            b = b"\xff" * 4 + t.encode()
            want = sum(math.log(p[b[i:i + 5]]) for i in range(len(b) - 4))
            assert math.isclose(got[d, "en", len(b) - 4].log_prob, want, rel_tol=1e-4)


def test_hash_arrays():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(0, 1 << 40, 5000).astype(np.uint64))
    table = quality.SortedHashes(quality.SortedHashes.parts(keys, -np.arange(1, len(keys) + 1).astype(np.float32)))
    pick = rnd.permutation(len(keys))
    assert (table.find(keys[pick]) == -(pick + 1)).all()
    assert (table.find(np.array([1 << 41], np.uint64)) == -len(keys)).all()
    assert quality.SortedHashes(quality.SortedHashes.parts(keys[:0], np.zeros(0, np.float32))).find(keys[:3]).shape == (3,)


def test_junk_is_rejected_and_prose_kept(spark):
    rnd = random.Random(6)
    syllables = ["the", "and", "re", "th", "er", "on", "an", "in", "ing", "ea"]
    prose = lambda n: " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n)).capitalize() + "."
    rows = [(i, "en", " ".join(prose(12) for _ in range(rnd.randint(3, 30)))) for i in range(400)]
    junk = [(1000 + i, "en", " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(8)) for _ in range(80))) for i in range(8)]
    kept = {r.doc_id for r in quality.quality_verdicts(frame(spark, rows + junk)).collect() if r.kept}
    assert kept == set(range(400))


@pytest.mark.parametrize("near", [False, True])
def test_copies_do_not_close_the_band(spark, near):
    """Copies (or near copies) hold 80 % of a language; the clean documents beside them stay."""
    rnd = random.Random(7)
    syllables = ["the", "and", "re", "th", "er", "on", "an", "in", "ing", "ea"]
    prose = lambda n: " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n)) + "."
    one = prose(300)
    rows = [(i, "en", " ".join(prose(12) for _ in range(rnd.randint(3, 30)))) for i in range(60)]
    rows += [(1000 + i, "en", f"{one[:-4]} {i % 7}" if near else one) for i in range(240)]
    junk = [(2000 + i, "en", " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(8)) for _ in range(80))) for i in range(3)]
    kept = {r.doc_id for r in quality.quality_verdicts(frame(spark, rows + junk)).collect() if r.kept}
    assert kept == {r[0] for r in rows}


def test_stage_and_empty_table(spark):
    df = frame(spark, corpus(5))
    left = quality.quality_stage(df)
    assert left.columns == df.columns and left.dtypes == df.dtypes
    assert sorted((str(r.doc_id) for r in left.collect())) == sorted(str(r.doc_id) for r in quality.quality_verdicts(df).collect() if r.kept)
    assert quality.quality_stage(df.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op9_quality_rules(spark, SF).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted((d.doc_id, *base(d.text)) for d in docs)


def test_structured_runs_are_no_repeats():
    """Two-letter runs that are complements of each other are different lines and words."""
    from tests_runs import complements
    for size in (1024, 2048, 4096):
        a, b = complements(size)
        text = "\n".join([a, b, a + " " + "w " * 3, b + " " + "w " * 3]).encode()
        data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        got = quality._repeats(data, offsets)
        assert [int(x[0]) for x in got] == list(base(text.decode())[:5])


def test_nothing_moves_by_language(spark):
    """Rows of one language may be a third of all: no exchange is keyed by the language alone."""
    rows = spark.createDataFrame(corpus(3), "doc_id long, lang string, text string")
    plan = quality.judge(quality.measure(rows, ["doc_id"]), "c1", "c2")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in text.split("\n") if "Exchange hashpartitioning(c1#" in x and x.split("hashpartitioning(")[1].count(",") == 1]
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert len(moved) <= 2, moved  # the bands' own aggregates: pre-aggregated rows only
