"""Document fingerprints: a threshold-scaled sketch of word shingles.

A text's shingles are its runs of five words (``[^\\x20\\x09-\\x0D]+``, as written); a text of one to
four words has one shingle.  A shingle's hash is the first 48 bits of its MD5.  The sketch retains
every hash below a fixed fraction of the range, so its size grows with the text and sketches of one
fraction are closed under union: the sketch of several texts together is the union of theirs, and
the share of one sketch found in another estimates the containment of one text's shingles in the
other's, however unequal their lengths (a bottom-k sketch of a book keeps none of a page's hashes).

Everything here is a column expression or a DataFrame operation; no Python runs on the data.

* ``sketch(text)``: sorted distinct retained hashes, 12 hex digits each; ``to_string`` /
  ``from_string`` turn a sketch into its fingerprint and back, ``merged`` unites two.
* ``containment(a, b)``: share of ``a`` found in ``b``; ``jaccard(a, b)``.
* ``sketch_rows``: sketches in long form, (key, hash) once each, for collections of any size:
  ``collection_containment`` estimates how much of each text lies in each collection.
* ``fingerprint_edits``: each document beside an edited text made with the next document.

Defined cases: null text is empty; a text without words, or none of whose hashes is retained, has an
empty sketch (''), found in nothing but an empty one; equal sketches have likeness 1.  Documents are
ordered by falling doc_id, null ids last, equal ids by a digest of id and text; of rows with the
same id and text each is followed by the next of them, the last by the next other document.  An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.encode import index_by_order

N = 5
#: of 2 ** 32: a hash is retained below this share of the range
FRACTION = 0.25
DIGITS = 12
SPACES = " \t\n\x0b\x0c\r"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def shingles(text: Column, n: int = N) -> Column:
    """Runs of ``n`` words joined by a space, with repeats."""
    none = F.array().cast("array<string>")

    def of(words):
        runs = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)]))
        return F.when(words[0] == "", none).when(F.size(words) < n, F.array(F.concat_ws(" ", words))).otherwise(runs)

    return _let(F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), r"[\x20\x09-\x0D]+"), of)


def sketch(text: Column, n: int = N, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes of the text's shingles below ``fraction`` of the range."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be above 0 and at most 1")
    hashes = F.transform(shingles(text, n), lambda s: F.substring(F.md5(s), 1, DIGITS))
    if fraction < 1:
        cut = F.lit(f"{int(fraction * 2 ** 32):08x}")  # digits compare as the numbers do
        hashes = F.filter(hashes, lambda h: h < cut)
    return F.array_sort(F.array_distinct(hashes))


def to_string(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def from_string(fingerprint: Column) -> Column:
    """The sketch that ``to_string`` made the fingerprint of."""
    count = (F.length(fingerprint) / DIGITS).cast("int")
    each = F.transform(F.sequence(F.lit(1), count), lambda i: F.substr(fingerprint, (i - 1) * DIGITS + 1, F.lit(DIGITS)))
    return F.when(F.coalesce(fingerprint, F.lit("")) == "", F.array().cast("array<string>")).otherwise(each)


def packed(hashes: Column) -> Column:
    """The sketch in 6 bytes a hash, for shuffles."""
    return F.unhex(to_string(hashes))


def unpacked(raw: Column) -> Column:
    return _let(F.lower(F.hex(raw)), from_string)


def merged(a: Column, b: Column) -> Column:
    """The sketch of both texts together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has."""
    found = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) == 0, (F.size(b) == 0).cast("double")).otherwise(found / F.size(a))


def jaccard(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of either text that both have."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def sketch_rows(docs: DataFrame, key: str, text_col: str = "text", n: int = N, fraction: float = FRACTION) -> DataFrame:
    """(key, hash), each once: the sketch of all texts of a key.  Tables merge by union and distinct."""
    own = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.explode(sketch(F.col(text_col), n, fraction)).alias("hash"))
    return own.distinct()


def collection_containment(docs: DataFrame, collections: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           n: int = N, fraction: float = FRACTION) -> DataFrame:
    """(id, key, n_hashes, n_found, containment): how much of each document lies in each collection of
    ``sketch_rows``, where any does.  Rows that share an id are one text."""
    own = sketch_rows(docs, id_col, text_col, n, fraction).withColumnRenamed("key", "id")
    size = own.groupBy("id").agg(F.count("*").alias("n_hashes"))
    found = own.join(collections.select("key", "hash"), "hash").groupBy("id", "key").agg(F.count("*").alias("n_found"))
    return found.join(size, "id").select("id", "key", "n_hashes", "n_found", (F.col("n_found") / F.col("n_hashes")).alias("containment"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, fraction: float = FRACTION) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text is the text with its last ``floor(n_chars / 3)`` code points replaced by the first
    as many (or all) of the next document.  Texts move twice at most: to the narrow row that says what
    the document before asks for, and, only the part asked for, to that document.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(" "), F.col("text"))))
    groups = rows.select("key", "doc_id", F.length("text").alias("n")).groupBy("key").agg(
        F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count("*").alias("copies"))
    placed = index_by_order(groups, [F.col("doc_id").desc_nulls_last(), F.col("key")], "at")
    count = placed.count()
    follows = placed.select(F.col("key").alias("next"), F.pmod(F.col("at") - 1, F.lit(max(count, 1))).alias("before_at"))
    asked = (placed.select("at", F.col("key").alias("before"), F.expr("int(n div 3)").alias("ask")).join(follows, F.col("at") == F.col("before_at"))
             .select(F.col("next").alias("key"), "before", "ask"))
    about = asked.join(placed.select("key", "doc_id", "copies"), "key")
    # the narrow side is the hashed one: texts stream through without a sort.  Both uses of ``whole``
    # read the same columns of ``rows``, so its texts are shuffled once
    whole = rows.select("key", "text").join(about.hint("shuffle_hash"), "key")
    if not placed.where("copies > 1").isEmpty():
        whole = whole.where("copies = 1").unionByName(whole.where("copies > 1").dropDuplicates(["key"]))
    mark = lambda t: sketch(t, n, fraction)
    given = whole.select(F.col("before").alias("key"), F.expr("substring(text, 1, ask)").alias("given"), packed(mark(F.col("text"))).alias("next_sketch"))
    own = whole.select("key", "doc_id", "copies", "text").join(given, "key").withColumn("n_chars", F.length("text"))
    edit = lambda tail: F.concat(F.expr("substring(text, 1, n_chars - int(n_chars div 3))"), tail)
    # a copy that isn't the last is followed by itself
    one = own.select("doc_id", "n_chars", "next_sketch", mark(F.col("text")).alias("sketch"), edit(F.col("given")).alias("edited"),
                     F.when(F.col("copies") > 1, edit(F.expr("substring(text, 1, int(n_chars div 3))"))).alias("edited_copy"),
                     F.sequence(F.lit(1).cast("long"), "copies").alias("each"))
    done = one.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "sketch", "next_sketch", "each",
                      F.sha2("edited", 256).alias("sha"), mark(F.col("edited")).alias("edited_sketch"),
                      F.when(F.col("edited_copy").isNotNull(), F.sha2("edited_copy", 256)).alias("copy_sha"),
                      F.when(F.col("edited_copy").isNotNull(), mark(F.col("edited_copy"))).alias("copy_sketch"))
    last = F.col("k") == 1
    each = done.select("*", F.explode("each").alias("k")).select(
        "doc_id", "n_chars", "sketch", F.when(last, F.col("sha")).otherwise(F.col("copy_sha")).alias("edited_sha256"),
        F.when(last, F.col("edited_sketch")).otherwise(F.col("copy_sketch")).alias("e"),
        F.when(last, unpacked(F.col("next_sketch"))).otherwise(F.col("sketch")).alias("x"))
    return each.select("doc_id", "n_chars", "edited_sha256", to_string(F.col("sketch")).alias("fingerprint"), to_string(F.col("e")).alias("edited_fingerprint"),
                       containment(F.col("sketch"), F.col("e")).alias("near_edited"), containment(F.col("sketch"), F.col("x")).alias("near_next"))
