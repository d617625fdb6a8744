"""Raw landing: append one batch of a source with its lineage and ingest order.

A batch is written into a folder of its own and becomes part of the source when
the source's manifest names it. The manifest also holds the ids of every batch,
so that the next one is numbered without reading any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import manifest, schemas
from ..literals import literal_table
from ..operators.ordering import key_bucket
from .drops import POSITION

LANDING = schemas.struct(schemas.LANDING_COLUMNS)

# Runs of 2**20 raw ids: any order along them can be cut here.
SLICE_BITS = 20

# Ids that Spark gives while a batch is written: the task, then the place in it.
PLACE_BITS = 33

# An order of more rows than this is not left to one task.
CROWD = 1 << 20

BATCH, ATTEMPT, ORDER_BUCKET = "batch_id", "attempt", "order_bucket"

# Rows of one source from oldest to newest.
INGEST_ORDER = ["batch_id", "source_file", "raw_id"]


def raw_slice() -> Column:
    """Monotone, bounded cut of the order inside a batch (see ``line_position``)."""
    return F.struct(
        F.coalesce("source_file", F.lit("")).alias("file"),
        F.shiftright("raw_id", SLICE_BITS).alias("run"),
    )


def raw_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *LANDING.fields])


def read_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    after: int | None = None,
    upto: int | None = None,
    buckets: Sequence[int] | None = None,
) -> DataFrame:
    """The landed batches of a source; empty before the first landing.

    ``after`` and ``upto`` bound the batch, ``buckets`` the order buckets: other
    folders are not opened.
    """
    full = raw_schema(schema)
    held = manifest.current(spark, path)
    if held is None:
        if not manifest.exists(spark, path):
            return literal_table(spark, [], full)
        return spark.read.schema(full).parquet(path)
    folders = [
        f"{path}/{folder}"
        for batch, folder in held.folders.items()
        if (after is None or int(batch) > after) and (upto is None or int(batch) <= upto)
    ]
    if not folders:
        return literal_table(spark, [], full)
    stored = T.StructType([
        *full.fields, T.StructField(ATTEMPT, T.StringType()), T.StructField(ORDER_BUCKET, T.IntegerType())
    ])
    rows = spark.read.schema(stored).option("basePath", path).parquet(*folders)
    if buckets is not None:
        rows = rows.where(F.col(ORDER_BUCKET).isin(list(buckets)))
    return rows.select(*full.names)


def crowded_orders(spark: SparkSession, path: str) -> list[str]:
    """Orders that have very many rows in some batch."""
    held = manifest.current(spark, path)
    noted = held.notes.get("crowded", {}) if held else {}
    return sorted({name for names in noted.values() for name in names})


def order_bucket(key: Column, buckets: int) -> Column:
    """Where the rows of an order lie inside a batch."""
    return key_bucket([key.cast("string")], buckets)


def _numbered(rows: DataFrame, base: int) -> DataFrame:
    """``raw_id`` from ``base + 1`` on without a gap, along the order that the rows were written in.

    ``_at`` is the task that wrote a row and its place there. Tasks are counted,
    and the counts of the tasks before are added to the place; of a stored batch
    this is the same however often a task is repeated.
    """
    task, place = F.shiftright("_at", PLACE_BITS), F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # One row for each task that wrote.
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(task.alias("_task"))
        .agg(F.count("*").alias("_n"))
        .select("_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        rows.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")  # so that no row is moved for them
        .withColumn("raw_id", F.lit(base + 1) + F.col("_before") + place)
        .drop("_task", "_before", "_at")
    )


def land(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    batch_id: int,
    order_by: list[str] | None = None,
    order_key: Column | None = None,
    buckets: int = 8,
    crowd: int = CROWD,
    noted: dict | None = None,
) -> int:
    """Write one batch and return its row count.

    Nothing is deduplicated: a drop that comes again is landed again, as a new
    batch. Landing the same ``batch_id`` again replaces that batch, with no rows
    too, so a run that failed half way can be repeated; until a landing is whole,
    readers see the source as it was. ``raw_id`` grows along ``order_by``, or along
    the position in the file, and leaves no number out; a batch that is landed
    again takes new ones only if it has grown and later ones follow. With
    ``order_key`` the rows lie in ``buckets`` folders by their order, and orders of
    more than ``crowd`` rows are noted for those who group by order. ``noted`` is
    written with the batch or not at all.
    """
    held = manifest.begin(spark, path)
    buckets = held.notes.get("buckets", buckets)
    used: dict[str, list[int]] = dict(held.notes.get("ids", {}))
    if order_by:
        rows = rows.sort(*order_by)
    lineage = set(POSITION.names) & set(rows.columns)
    source_file = F.col("source_file") if "source_file" in lineage else F.lit(None)
    attempt = manifest.fresh(held.version + 1)
    incoming = f"{path}/_incoming/{attempt}"
    (
        rows.select(
            *schema.names,
            F.monotonically_increasing_id().alias("_at"),
            source_file.cast("string").alias("source_file"),
            F.current_timestamp().alias("ingested_at"),
        ).write.option("compression", "zstd").parquet(incoming)
    )
    staged = spark.read.parquet(incoming)
    count = staged.count()
    others = {b: ids for b, ids in used.items() if b != str(batch_id)}
    mine = used.get(str(batch_id))
    top = max((last for _, last in others.values()), default=0)
    base = mine[0] - 1 if mine and (mine[1] > top or count <= mine[1] - mine[0] + 1) else top
    folder = f"{BATCH}={batch_id}/{ATTEMPT}={attempt}"
    if count:
        bucket = F.lit(0) if order_key is None else order_bucket(order_key, buckets)
        (
            _numbered(staged, base)
            .withColumn(ORDER_BUCKET, bucket)
            .write.option("compression", "zstd")
            .partitionBy(ORDER_BUCKET)
            .parquet(f"{path}/{folder}")
        )
    crowded = {b: names for b, names in held.notes.get("crowded", {}).items() if b != str(batch_id)}
    if order_key is not None and count > crowd:
        sizes = staged.select(order_key.cast("string").alias("_order")).groupBy("_order").count()
        # Fewer than ``count / crowd`` names.
        many = sizes.where((F.col("count") > crowd) & F.col("_order").isNotNull())
        crowded[str(batch_id)] = sorted(row[0] for row in many.collect())
    folders = {b: f for b, f in held.folders.items() if b != str(batch_id)}
    if count:
        folders[str(batch_id)] = folder
        others[str(batch_id)] = [base + 1, base + count]
    manifest.switch(spark, path, held, folders, {
        **held.notes, **(noted or {}), "ids": others, "crowded": crowded, "buckets": buckets
    })
    manifest.remove(spark, incoming)
    return count
