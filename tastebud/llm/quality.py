"""Quality rules: repetition counts and an n-gram perplexity band per language.

The language model is a modified Kneser-Ney model of the corpus itself over UTF-8 bytes: every
position of every text is counted (with its ``order - 1`` preceding bytes, padded at the start),
continuation counts, discounts and interpolated probabilities are Spark aggregations and joins,
one model per language.  Models are stored as sorted arrays of hashed n-grams beside their log
probabilities, with a directory over the leading hash bits.  While all entries fit
``MAX_ENTRIES`` the arrays are broadcast; beyond it scoring is a join on (language, n-gram).

A document is kept if it passes the base rules and its log perplexity per word, ``-log p(text) /
n_words``, lies inside its language's band, ``median - LOW * spread .. median + HIGH * spread``.
Median and spread (the distance between the quartiles) are those of the language's distinct texts
that pass the base rules, so copies of a text weigh as one; the spread is ``MIN_SPREAD`` times the
median at least, so a group of near copies doesn't close the band around itself.  Means over short
texts scatter more, so both limits widen by ``1 + SHORT_BYTES / n_bytes``.

Defined cases: null or empty text has no words and fails the base rules; a null language is a
language of its own; repeated rows are counted and judged one by one; an empty table gives an
empty result; further columns pass through the stage unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import textops as tx

ORDER = 5
#: bytes whose n-grams are made at once (some 100 bytes of working memory each)
GRAM_BLOCK = 1 << 19
#: broadcast bound: 12 bytes an entry
MAX_ENTRIES = 6_000_000
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
LOW, HIGH, SHORT_BYTES = 9.0, 4.5, 400
#: least spread of a band, as a share of its median (0.041 to 0.055 in the languages of the test tables)
MIN_SPREAD = 0.02
#: tables with one row per language are broadcast up to so many languages, counted first
MAX_LANGUAGES = 10_000
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The n-gram ending at each byte as an integer, bytes before a text's start being 0xFF."""
    n, pad = len(offsets) - 1, order - 1
    row = np.repeat(np.arange(1, n + 1) * pad, np.diff(offsets))
    at = np.arange(len(data)) + row
    padded = np.full(len(data) + (n + 1) * pad, 0xFF, np.uint64)
    padded[at] = data
    g = padded.copy()
    for j in range(1, order):
        g[j:] |= padded[:-j] << tx.U(8 * j)
    return g[at]


def _language_codes(column: pa.Array) -> tuple[np.ndarray, list]:
    coded = column.cast(pa.string()).dictionary_encode("encode")
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.uint64), coded.dictionary.to_pylist()


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted list of keys with summed counts."""
    k, n = (np.concatenate(x) for x in zip(*parts))
    by = np.argsort(k, kind="stable")
    k, n = k[by], n[by]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[first], np.add.reduceat(n, first)


def _count(batches, order: int, pending: int = 500_000, flush: int = 1_500_000, rows: int = 100_000):
    """(lang, gram, n), summed within a task as far as bounded memory allows."""
    held: dict[str, list] = {}  # per language: merged counts, then blocks' counts not merged yet
    waiting = 0

    def merge():
        for lang, parts in held.items():
            held[lang] = [_merged(parts)]

    def out():
        for lang, parts in held.items():
            for keys, n in parts:
                for i in range(0, len(keys), rows):
                    k = keys[i:i + rows]
                    yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(k), np.int32))), pa.array(tx.as_long(k)), pa.array(n[i:i + rows])], names=["lang", "gram", "n"])
        held.clear()
        tx.release()

    for batch in batches:
        codes, names = _language_codes(batch.column(0))
        for a, b, data, offsets in tx.text_blocks(batch.column(1), GRAM_BLOCK):
            if not len(data):
                continue
            g = _grams(data, offsets, order) | (np.repeat(codes[a:b], np.diff(offsets)) << tx.U(8 * order))
            g.sort()
            first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            n = np.diff(np.append(first, len(g)))
            g = g[first]
            code = g >> tx.U(8 * order)
            for c in np.unique(code):
                own = code == c
                held.setdefault(names[int(c)], []).append((g[own] & tx.U((1 << 8 * order) - 1), n[own]))
            waiting += len(g)
            if waiting > pending:
                merge()
                waiting = 0
                if sum(len(p[0][0]) for p in held.values()) > flush:
                    yield from out()
    merge()
    yield from out()


def _language(col) -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ngram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over every position of every text."""
    parts = docs.select(_language(lang_col), F.col(text_col)).mapInArrow(lambda it: _count(it, order), "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _small_side(of: DataFrame, lang: str):
    """How to join ``of`` with one row per language: by broadcast while its languages are few, so
    that rows never move by language."""
    return F.broadcast if of.select(lang).distinct().count() <= MAX_LANGUAGES else (lambda df: df)


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, p): interpolated modified Kneser-Ney probability of each n-gram's last byte."""
    levels, small = [counts], _small_side(counts, "lang")
    for k in range(order - 1, 0, -1):  # continuation counts: in how many longer n-grams it is the end
        shorter = levels[-1].groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).agg(F.count("*").alias("n"))
        levels.append(materialize(shorter)[0])  # read four times below; keeps each step's plan small
    lower = None
    for k, level in enumerate(reversed(levels), start=1):
        of = [F.sum((F.col("n") == i).cast("long")).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        cut = lambda i: F.when((F.col(f"n{i}") > 0) & (F.col("n1") > 0), F.greatest(F.lit(0.0), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))).otherwise(F.lit(0.5))
        cuts = level.groupBy("lang").agg(*of).select("lang", *[cut(i).alias(f"d{i}") for i in (1, 2, 3)])
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = level.join(small(cuts), "lang").select("lang", "gram", F.shiftright("gram", 8).alias("h"), F.col("n").cast("double").alias("n"), F.least(d, F.col("n")).alias("d"))
        context = rows.groupBy("lang", "h").agg(F.sum("n").alias("all"), F.sum("d").alias("saved"))
        rows = rows.join(context, ["lang", "h"])
        if lower is None:
            below = F.lit(1 / 256)
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            rows = rows.withColumn("suffix", suffix).join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
            below = F.col("below")
        lower = rows.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("all") + F.col("saved") / F.col("all") * below).alias("p"))
        lower, _ = materialize(lower)
    return lower


class SortedHashes:
    """Hashed n-grams in order, their log probabilities, and a directory by leading bits."""

    def __init__(self, parts: tuple):
        self.h, self.values, self.first, shift, self.rest = parts
        self.shift = tx.U(shift)

    @staticmethod
    def parts(keys: np.ndarray, values: np.ndarray) -> tuple:
        """What a table is made of: plain arrays, which is what is broadcast."""
        h = tx.mix(keys)
        by = np.argsort(h)
        h, values = h[by], values[by].astype(np.float32)
        bits = max(1, int(len(h)).bit_length())
        first = np.searchsorted(h >> tx.U(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        return h, values, first, 64 - bits, float(values.min()) if len(h) else float(np.log(1 / 256))

    def find(self, keys: np.ndarray) -> np.ndarray:
        h = tx.mix(keys)
        slot = h >> self.shift
        at, stop = self.first[slot], self.first[slot + tx.U(1)]
        out = np.full(len(h), self.rest, np.float32)
        open_ = np.flatnonzero(at < stop)
        at, stop, h = at[open_], stop[open_], h[open_]
        while len(open_):
            hit = self.h[at] == h
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (at + 1 < stop)
            open_, at, stop, h = open_[on], at[on] + 1, stop[on], h[on]
        return out


def _repeats(data, offsets):
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n = len(offsets) - 1
    s, e, row = tx.word_spans(data, offsets)
    n_words = np.bincount(row, minlength=n)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    word_chars = total(((data & 0xC0) != 0x80) & ~tx.SPACE[data])
    n_symbols = total(_SYMBOL[data])
    salt = tx.mix(np.arange(n, dtype=np.uint64) + tx.U(11))

    def again(h):
        """Entries equal to another one."""
        order = np.sort(h)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        if not len(twice):
            return np.zeros(len(h), bool)
        at = np.searchsorted(twice, h)
        at[at == len(twice)] = 0
        return twice[at] == h

    windows, first = tx.run_hashes(tx.digests(data, s, e, False, 9)[0], row, WINDOW)
    edge = np.zeros(len(s) + 1, np.int64)
    if len(first):
        first = first[again(windows ^ salt[row[first]])]
        np.add.at(edge, first, 1)
        np.add.at(edge, first + WINDOW, -1)
    n_repeat = np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=n)
    ls, le, lrow = tx.line_spans(data, offsets)
    words_before = np.searchsorted(s, ls)
    full = np.flatnonzero(np.searchsorted(s, le) > words_before)
    h = tx.digests(data, ls[full], le[full], False, 9)[0] ^ salt[lrow[full]]
    twice = again(h)
    h, r = h[twice], lrow[full][twice]
    _, keep = np.unique(h, return_index=True)
    return n_words, word_chars, n_symbols, np.bincount(r, minlength=n) - np.bincount(r[keep], minlength=n), n_repeat


METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long, log_prob double"
_METRIC_NAMES = [m.split()[0] for m in METRICS.split(", ")]


def _measure(batches, n_in: int, order: int, shared):
    """Metrics of each row from its (lang, text), the last two columns, after its first ``n_in`` columns."""
    models = {k: SortedHashes(p) for k, p in shared.value.items()} if shared is not None else {}
    for batch in batches:
        codes, names = _language_codes(batch.column(n_in))
        parts = []
        for a, b, data, offsets in tx.text_blocks(batch.column(n_in + 1), GRAM_BLOCK):
            log_prob = np.zeros(b - a)
            size = np.diff(offsets)
            if shared is not None and len(data):
                grams, code = _grams(data, offsets, order), np.repeat(codes[a:b], size)
                logs = np.zeros(len(data))
                for c in np.unique(code):
                    own = code == c
                    logs[own] = models[names[int(c)]].find(grams[own])
                log_prob = np.diff(np.concatenate([[0.0], np.cumsum(logs)])[offsets])
            parts.append((*_repeats(data, offsets), size, log_prob))
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0)] * 7
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:n_in], *[pa.array(c.astype(np.int64)) for c in columns[:6]], pa.array(columns[6].astype(np.float64))],
            names=[f"c{i}" for i in range(n_in)] + _METRIC_NAMES)
    models.clear()  # the worker lives on
    tx.release()


def _doc_grams(batches, order: int):
    """(row, lang, gram, n) of each text, for scoring by a join."""
    for batch in batches:
        codes, names = _language_codes(batch.column(1))
        rows = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in tx.text_blocks(batch.column(2)):
            if not len(data):
                continue
            g, row = _grams(data, offsets, order), np.repeat(np.arange(b - a), np.diff(offsets))
            by = np.lexsort((g, row))
            g, row = g[by], row[by]
            first = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (row[1:] != row[:-1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[a:b][row[first]]), pa.array([names[int(c)] for c in codes[a:b][row[first]]], pa.string()),
                 pa.array(tx.as_long(g[first])), pa.array(np.diff(np.append(first, len(g))))], names=["r", "lang", "gram", "n"])


def load_models(model: DataFrame) -> dict[str, tuple]:
    """The parts of each language's sorted hash arrays; the caller has checked the number of entries."""
    t = model.select("lang", "gram", F.log("p").cast("float").alias("v")).toArrow()
    codes, names = _language_codes(t.column("lang"))
    grams, values = t.column("gram").to_numpy().astype(np.uint64), t.column("v").to_numpy()
    return {name: SortedHashes.parts(grams[codes == c], values[codes == c]) for c, name in enumerate(names)}


def measure(docs: DataFrame, keep: list[str], lang_col: str = "lang", text_col: str = "text", order: int = ORDER, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """Columns ``keep`` as c0.., lang, a hash of the text, and the metrics with the model of all of ``docs``; written once."""
    spark = docs.sparkSession
    counts, _ = materialize(ngram_counts(docs, lang_col, text_col, order))
    model = kneser_ney(counts, order)
    entries = model.count()
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], _language(lang_col).alias(f"c{len(keep)}"), F.xxhash64(F.col(f"`{text_col}`")).alias(f"c{len(keep) + 1}"))
    n = len(plain.columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema) + ", " + METRICS
    given = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], _language(lang_col).alias(f"c{n - 2}"), F.xxhash64(F.col(f"`{text_col}`")).alias(f"c{n - 1}"), _language(lang_col), F.col(f"`{text_col}`"))
    if entries <= max_entries:
        shared = spark.sparkContext.broadcast(load_models(model))
        measured, _ = materialize(given.mapInArrow(lambda it: _measure(it, n, order, shared), schema))
        shared.destroy()  # the scores are written
        return measured
    # number the rows by writing them once, then gather each row's score by a join
    numbered, _ = materialize(given.toDF(*[f"c{i}" for i in range(n)], "lang_in", "text_in").withColumn("r", F.monotonically_increasing_id()))
    grams = numbered.select("r", "lang_in", "text_in").mapInArrow(lambda it: _doc_grams(it, order), "r long, lang string, gram long, n long")
    scores = grams.join(model, ["lang", "gram"]).groupBy("r").agg(F.sum(F.col("n") * F.log("p").cast("float")).alias("score"))
    base = numbered.select(*[f"c{i}" for i in range(n)], F.col("r").alias(f"c{n}"), "lang_in", "text_in")
    base = base.mapInArrow(lambda it: _measure(it, n + 1, order, None), schema.replace(", " + METRICS, f", c{n} long, " + METRICS))
    joined = base.join(scores, F.col(f"c{n}") == F.col("r"), "left").withColumn("log_prob", F.coalesce("score", F.lit(0.0)))
    return materialize(joined.drop(f"c{n}", "r", "score"))[0]


def judge(measured: DataFrame, lang: str, text_hash: str, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Adds base_failed, log_perplexity and kept."""
    x = F.when(F.col("n_words") > 0, -F.col("log_prob") / F.greatest("n_words", F.lit(1))).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = measured.withColumns({"base_failed": failed, "log_perplexity": x})
    distinct = rows.where(~F.col("base_failed")).groupBy(lang, text_hash, "n_bytes").agg(F.min("log_perplexity").alias("log_perplexity"))
    bands = (distinct.groupBy(lang).agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("q"))
             .select(F.col(lang).alias("band_lang"), F.col("q")[1].alias("median"), F.greatest(F.col("q")[2] - F.col("q")[0], MIN_SPREAD * F.col("q")[1]).alias("spread")))
    rows = rows.join(_small_side(measured, lang)(bands), F.col(lang) == F.col("band_lang"), "left")
    wide = F.col("spread") * (1 + SHORT_BYTES / F.greatest("n_bytes", F.lit(1)))
    inside = F.col("log_perplexity").between(F.col("median") - low * wide, F.col("median") + high * wide)
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop("band_lang")


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", **options) -> DataFrame:
    """doc_id, the counts, base_failed, log_perplexity, kept: one row per row of ``docs``."""
    rows = judge(measure(docs, [id_col], lang_col, text_col, **options), "c1", "c2")
    return rows.select(F.col("c0").alias("doc_id"), F.col("c1").alias("lang"), *_METRIC_NAMES, "base_failed", "log_perplexity", "median", "spread", "kept")


def quality_stage(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", **options) -> DataFrame:
    """The kept rows of ``docs``; same columns."""
    names = docs.columns
    rows = judge(measure(docs, names, lang_col, text_col, **options), f"c{len(names)}", f"c{len(names) + 1}")
    return rows.where("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
