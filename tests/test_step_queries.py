"""One step against SQL; draws that other engines can redo."""
import hashlib

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tastebud.operators import rank_mf
from tastebud.plans import step_queries


@pytest.mark.parametrize("loss", step_queries.LOSSES)
def test_step_equals_sql(spark, loss):
    con = duckdb.connect()
    for t in ("embeddings", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    names = ["side", "feature", "component", "value", "grad2"]
    want = {r[:3]: r[3:] for r in con.execute(f"SELECT {', '.join(names)} FROM ({step_queries.SQL[f'{loss}_step_fixed']})").fetchall()}
    got = {tuple(r)[:3]: tuple(r)[3:] for r in step_queries.QUERIES[f"{loss}_step_fixed"](spark, SF).select(*names).collect()}
    assert got == want
    assert sum(g2 > 1 for _, g2 in got.values()) > len(got) / 2  # most features were touched


def test_md5_draws(spark):
    rows = spark.range(50).select(F.col("id").alias("user"), (F.col("id") * 3).alias("item"), (F.col("id") % 4).cast("int").alias("t"))
    seed_cols = [F.lit(42), F.lit(1), F.lit(2), F.col("user"), F.col("item")]
    for r in rows.withColumn("j", rank_mf._draw(seed_cols, F.col("t"), 17, "md5")).collect():
        assert r.j == int(hashlib.md5(f"42|1|2|{r.user}|{r.item}|{r.t}".encode()).hexdigest()[:15], 16) % 17


def test_draw_hash_is_validated(spark):
    inter = spark.createDataFrame([(1, 2)], "user long, item long")
    with pytest.raises(ValueError):
        rank_mf.fit_rank_mf(inter, draw_hash="sha1")
    with pytest.raises(ValueError):
        rank_mf.fit_rank_mf(inter, draw_hash="md5", method="strata")
