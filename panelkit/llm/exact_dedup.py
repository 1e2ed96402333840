"""Exact de-duplication with stateful streaming.

A feed of digests is read as a stream. The keyed state (RocksDB on the executors' disks,
snapshots in the shared folder, no watermark and so no expiry) holds for every digest the
smallest identifier, the place of that row in the feed, and the number of rows. A later feed
with the same state folder is de-duplicated against all earlier ones. On hits the full bytes
decide: all texts of a digest are compared, and a digest that stands for several texts is
taken apart by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.common import SPACE, whole_text
from panelkit.session import materialise, new_path

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # without it each partition of the state reserves 4 MB for a log of a few hundred bytes
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
BYTES_PER_BATCH = 8 << 30


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(whole_text(text), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _first() -> Column:
    """The row with the smallest id, of equal ids the first in the feed; no id comes last."""
    return F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "place")).alias("first")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def update_state(feed: DataFrame, state: str, feed_paths: str) -> None:
    """Run all new files under ``feed_paths`` through the state kept in the folder ``state``.

    ``feed`` gives the schema. Rows without an id sort after all others.
    """
    spark = feed.sparkSession
    with _settings(spark, STATE_SETTINGS):
        query = (
            spark.readStream.schema(feed.schema)
            .option("maxBytesPerTrigger", BYTES_PER_BATCH)
            .parquet(feed_paths)
            .groupBy("digest", "n_bytes")
            .agg(
                _first(),
                F.count(F.lit(1)).alias("group_size"),
            )
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """digest, n_bytes, keep_id, keep_place, group_size: one row per key of the state."""
    stored = spark.read.format("statestore").load(state)
    first, size = stored.schema["value"].dataType.fieldNames()
    return stored.select(
        "key.digest",
        "key.n_bytes",
        F.col("value")[first]["id"].alias("keep_id"),
        F.col("value")[first]["place"].alias("keep_place"),
        F.col("value")[size].alias("group_size"),
    )


def digest_feed(
    docs: DataFrame, id_column: str, text_column: str, digest: Callable[[Column], Column]
) -> DataFrame:
    """One row per document: id, digest of the normalised text, its bytes, place in the feed."""
    return docs.select(
        F.col(id_column).cast("long").alias("id"), normalised(F.col(text_column)).alias("text")
    ).select(
        "id",
        digest(F.col("text")).alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("place"),
    )


def _several_texts(
    docs: DataFrame, text_column: str, digest: Callable[[Column], Column]
) -> DataFrame:
    """Digests that stand for more than one text, found by comparing full bytes.

    Each task sends at most two texts per digest, so that a group with a third of all rows
    weighs no more than others.
    """
    return (
        docs.select(normalised(F.col(text_column)).alias("text"))
        .groupBy(
            digest(F.col("text")).alias("digest"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        )
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .filter("low != high")
        .select("digest", "n_bytes")
    )


def _by_text(
    docs: DataFrame,
    mixed: DataFrame,
    id_column: str,
    text_column: str,
    digest: Callable[[Column], Column],
) -> DataFrame:
    """The rows of colliding digests, grouped by their texts."""
    text = normalised(F.col(text_column))
    rows = materialise(
        docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
        .withColumn("digest", digest(F.col("text")))
        .withColumn("n_bytes", F.octet_length("text").cast("long"))
        .join(mixed, ["digest", "n_bytes"], "left_semi")
        .withColumn("place", F.monotonically_increasing_id()),
        "digest-collision-rows",
    )
    groups = rows.groupBy("text").agg(_first(), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, "text").select(
        "digest",
        "n_bytes",
        "id",
        "place",
        F.col("first.id").alias("keep_id"),
        F.col("first.place").alias("keep_place"),
        "group_size",
    )


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest, n_bytes.

    Texts that are equal after normalisation form a group; the row with the smallest id stays.
    Null texts count as empty. Of rows repeated with one id the first in the feed stays. A row
    without an id stays only where no row of its group has one. An empty table gives no rows.
    Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    feed_path, state = new_path(spark, "digest-feed"), new_path(spark, "digest-state")
    digest_feed(docs, id_column, text_column, digest).write.parquet(feed_path)
    feed = spark.read.parquet(feed_path)
    update_state(feed, state, feed_path)
    result = feed.join(read_state(spark, state), ["digest", "n_bytes"])
    mixed = materialise(_several_texts(docs, text_column, digest), "digest-collisions")
    if not mixed.isEmpty():
        result = result.join(mixed, ["digest", "n_bytes"], "left_anti").unionByName(
            _by_text(docs, mixed, id_column, text_column, digest)
        )
    return result.select(
        "id",
        "keep_id",
        "group_size",
        (F.col("place") == F.col("keep_place")).alias("kept"),
        "digest",
        "n_bytes",
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, one row of each group of equal texts, with all their columns.

    Null texts count as empty, and an empty table stays empty. Of rows that share id and normalised
    text the first by their other columns stays (columns that have no order, such as maps, are not
    looked at). Rows travel as one struct, so columns may have any names.
    """
    stays = (
        exact_dedup(docs, id_column, text_column)
        .filter("kept")
        .select(F.col("id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    )
    ordered = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_column).cast("long").alias("id"),
        sha256(normalised(F.col(text_column))).alias("digest"),
    )
    met = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    same = Window.partitionBy("id", "digest").orderBy(*(F.col("row").getField(c) for c in ordered))
    kept = rows.join(stays, met, "left_semi").withColumn("n", F.row_number().over(same))
    return kept.filter("n = 1").select("row.*")
