"""What the operators share: stored tables, Arrow columns beside others, joins on hot keys."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import osspulse

# Bytes of text that a Python task holds at once; a longer single text is held alone.
SLICE_BYTES = 2 << 20
# A key with more rows than this share of all, and than the least number, is hot: so at most HOT_PARTS keys are.
HOT_PARTS, HOT_LEAST = 500, 1000


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever they may run."""
    context, root = spark.sparkContext, Path(osspulse.__file__).parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="osspulse-code-")) / "osspulse.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema: T.StructType) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares (`spark.checkpoint.dir`); a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="osspulse-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: later work does not repeat it.

    The files stay until the shared folder is cleaned, like those of `checkpoint()`.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` without columns of these names, so that an operator's own columns replace them."""
    return df.drop(*names)


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """`df` under column names that clash with nothing, the new name of each old one, and the way back."""
    names = [f"_column{i}" for i in range(len(df.columns))]
    back = [F.col(new).alias(old) for old, new in zip(df.columns, names, strict=True)]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True)), back


def text_column(df: DataFrame, name: str) -> DataFrame:
    return df if df.schema[name].dataType == T.StringType() else df.withColumn(name, F.col(name).cast("string"))


def sliced(batch: pa.RecordBatch, at: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of `batch` whose column `at` has about `most` bytes each."""
    column, start, held = batch.column(at), 0, 0
    if column.nbytes <= most:
        if batch.num_rows:
            yield batch
        return
    for row, size in enumerate(pc.binary_length(column).to_pylist()):
        if held and held + (size or 0) > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size or 0
    yield batch.slice(start)


def with_arrow_columns(
    df: DataFrame,
    text: str,
    fields: Sequence[T.StructField],
    compute: Callable[[pa.Array], Sequence[pa.Array]],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """`df` with the columns that `compute` makes of each slice of the text column; clashing names are replaced."""
    kept = text_column(without(df, [f.name for f in fields]), text)
    schema = T.StructType([*kept.schema.fields, *fields])
    at = kept.columns.index(next(c for c in kept.columns if c.lower() == text.lower()))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, at, slice_bytes):
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part.column(at))], names=names)

    return map_arrow(kept, run, schema)


def text_key(text: str) -> list[Column]:
    """Equal for equal texts, and else different but with a chance of about 2**-96."""
    known = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(known).alias("_k1"), F.hash(known).alias("_k2")]


def is_hot(count: str, total: int) -> Column:
    return F.col(count) > F.lit(max(HOT_LEAST, total // HOT_PARTS))


def join_hot(big: DataFrame, small: DataFrame, keys: Sequence[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """`big` joined with `small`, which has one row per key. Rows of hot keys stay where they are.

    `hot`: the keys that have more than a fixed share of the rows, so not more than one over that
    share. They and their rows of `small` are broadcast; the other keys take a shuffle join, in which
    none of them is large. Keys are not null.
    """
    flag = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    marked = big.join(flag, list(keys), "left")
    few = F.broadcast(small.join(F.broadcast(hot.select(*keys)), list(keys), "left_semi"))
    often = marked.filter(F.col("_hot")).drop("_hot").join(few, list(keys), how)
    rest = marked.filter(F.col("_hot").isNull()).drop("_hot").join(small, list(keys), how)
    return often.unionByName(rest)


def least_hashed(rows: DataFrame, kind: str, id: str, most: int) -> tuple[DataFrame, dict]:
    """Of each kind the `most` rows with the least hash of the id, and how many rows each kind has.

    A bound on the hash, from the kinds' counts, leaves little more than that to rank, however many rows there are; the least
    hash itself is always within it. Rows of one id that tie are settled by their other columns' hash.
    """
    spark, draw = rows.sparkSession, F.xxhash64(F.col(id).cast("string"), F.lit("sample"))
    known = rows.filter(F.col(kind).isNotNull())
    found = known.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("least")).collect()
    bounds = [(r[0], max(r["least"], int(min(1.0, (2 * most + 50) / r["n"]) * (2**64 - 1)) - 2**63)) for r in found]
    schema = T.StructType([T.StructField("_k", rows.schema[kind].dataType), T.StructField("_bound", T.LongType())])
    near = known.join(F.broadcast(spark.createDataFrame([(k, min(b, 2**63 - 1)) for k, b in bounds], schema)), F.col(kind) == F.col("_k"))
    order = Window.partitionBy(kind).orderBy(draw, F.xxhash64(*rows.columns))
    ranked = near.filter(draw <= F.col("_bound")).withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= most).select(*rows.columns, "_rank"), {r[0]: r["n"] for r in found}


def bounded_sample(
    rows: DataFrame, kind: str, id: str, text: str, most_texts: int, most_bytes: int
) -> tuple[list[tuple], dict]:
    """(kind, id, text) of a sample of each kind, and how many rows each kind has.

    Of each kind the rows with the least hash of the id are taken, one at least, up to `most_texts` rows and until their
    texts have `most_bytes` bytes; of a longer single text its first `most_bytes` characters. So the
    driver gets not more than about twice `most_bytes` per kind (in ASCII). Rows without kind or text do not count.
    """
    known = rows.select(F.col(kind).alias("_kind"), F.col(id).alias("_id"), F.col(text).alias("_text"))
    known, key = known.filter("_kind is not null and _text is not null"), F.xxhash64("_text")
    sized = known.select("_kind", "_id", key.alias("_key"), F.octet_length("_text").alias("_size"))
    first, counts = least_hashed(sized, "_kind", "_id", most_texts)
    before = Window.partitionBy("_kind").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    chosen = first.filter(F.col("_before") < most_bytes).select("_kind", "_id", "_key")
    wanted = F.broadcast(chosen.distinct().toDF("_k", "_i", "_h"))
    same = (F.col("_kind") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_i")) & (key == F.col("_h"))
    found = known.join(wanted, same, "left_semi").select("_kind", "_id", F.substring("_text", 1, most_bytes).alias("_text"))
    return sorted((tuple(r) for r in found.distinct().collect()), key=repr), counts
