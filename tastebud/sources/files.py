"""File sources and sinks.

Explicit schemas by default: schema inference costs an extra pass over the input,
which at cluster scale means reading the data twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
])

ITEMS_SCHEMA = T.StructType([
    T.StructField("item", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])


def read_ratings(spark: SparkSession, path: str, schema: T.StructType | None = RATINGS_SCHEMA,
                 infer: bool = False) -> DataFrame:
    """Ratings CSV with a header (userId, movieId, rating, ...).

    Columns are taken by position and renamed to ``user, item, rating``; extra
    columns (timestamps) are pruned.  ``infer=True`` reproduces header inference.
    """
    reader = spark.read.option("header", True)
    if infer or schema is None:
        df = reader.option("inferSchema", True).csv(path)
        first = df.columns[:3]
        return df.select(F.col(first[0]).alias("user"), F.col(first[1]).alias("item"),
                         F.col(first[2]).cast("double").alias("rating"))
    # header names in the file differ from ours: read raw, rename by position, cast.
    raw = reader.csv(path)
    cols = raw.columns[:3]
    return raw.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(cols, schema.fields)])


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items CSV (movieId, title, genres) narrowed to ``item, title, genres``."""
    raw = spark.read.option("header", True).csv(path)
    cols = raw.columns[:3]
    return raw.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(cols, ITEMS_SCHEMA.fields)])


def read_psv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Pipe-separated file with header whose quote and escape character is a backslash.

    With quote = escape = backslash, a pipe inside ``\\...\\`` stays in the field and
    double-quote characters are plain text, which is how the likes / feature dumps
    were written.
    """
    reader = (spark.read.option("header", True).option("sep", "|")
              .option("quote", "\\").option("escape", "\\"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def load_dataset(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """A pre-split dataset stored as parquet: ``train``, ``test`` (user, item, value),
    optional ``item_features`` (item, feature, weight) and ``item_labels`` (item, label)."""
    out: dict[str, DataFrame] = {}
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs_conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("train", "test", "item_features", "item_labels"):
        full = f"{directory.rstrip('/')}/{name}"
        p = jvm_path(full)
        if p.getFileSystem(fs_conf).exists(p):
            out[name] = spark.read.parquet(full)
    missing = {"train", "test"} - out.keys()
    if missing:
        raise FileNotFoundError(f"dataset {directory} lacks {sorted(missing)}")
    return out


def write_recs(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: list[str] | None = None) -> None:
    """Sink for recommendation / score tables (parquet, optionally partitioned)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_factors(factors: dict[str, DataFrame], path: str) -> None:
    """Persist a model's state tables (one parquet folder per table)."""
    for name, df in factors.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_factors(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
