"""Regular-expression matches with their positions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,m:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (which never matches empty): start, end (code points), m.

    The pieces between the matches come from ``split``, so positions are running sums of the
    lengths of pieces and matches.
    """
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))

    def step(s, x):
        start = s["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(F.concat(s["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m")))).alias("out"), end.alias("at"))

    empty = F.lit(None).cast(SPAN)
    start = F.struct(F.coalesce(empty, F.array().cast(SPAN)).alias("out"), F.lit(0).alias("at"))
    return F.when(text.rlike(pattern), F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), start, step, lambda s: s["out"])).otherwise(F.array().cast(SPAN))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of (start, rank, end, kind) structs in that order, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def set_aside(docs: DataFrame, *new: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its own columns of the names ``new`` renamed (``_in`` appended until the name is free), and old -> new names."""
    taken, moved = {c.lower() for c in docs.columns} | {n.lower() for n in new}, {}
    for c in docs.columns:
        if c.lower() in {n.lower() for n in new}:
            free = c + "_in"
            while free.lower() in taken:
                free += "_in"
            taken.add(free.lower())
            moved[c] = free
    return docs.withColumnsRenamed(moved), moved
