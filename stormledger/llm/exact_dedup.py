"""Exact deduplication by a stream with disk-backed keyed state.

A digest log is landed first: one small row per document with its digest, its
identifier and the place of its content. A streaming aggregation over that log
keeps, for every digest and without expiry, the first identifier, its locator
and a count, in RocksDB state whose checkpoints lie in shared storage. Partial
sums are formed before the shuffle, so a digest that a third of all rows share
reaches the state as one row per task.

Equal digests are only hits. Their whole normalised texts are fetched and
compared with the text the locator of the group names, byte by byte; rows that
differ form groups of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stormledger.llm.common import kept, scratch, text_of

STATE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MEMORY = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
MEMORY_MB = "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
#: Stores of a query that has ended are closed at the next upkeep.
UPKEEP = "spark.sql.streaming.stateStore.maintenanceInterval"
#: Many small stores: no space is set aside ahead of use, and a batch saves its changes only.
PREALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: Members of a group that are compared with one copy of the group's text.
MEMBERS_PER_COPY = 256


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass(frozen=True)
class Folders:
    """Where the log, the state and the changes of one deduplication live."""

    log: str
    state: str
    changes: str

    @classmethod
    def below(cls, path: str) -> Folders:
        return cls(f"{path}/log", f"{path}/state", f"{path}/changes")


def land(docs: DataFrame, folders: Folders, digest=sha256, id_col="doc_id", text_col="text") -> None:
    """Append documents to the digest log."""
    docs.select(
        F.col(id_col).alias("id"),
        F.input_file_name().alias("locator"),
        digest(normalised(text_of(text_col))).alias("digest"),
    ).write.mode("append").parquet(folders.log)


def first_of(id_col: str = "id", locator: str = "locator") -> Column:
    """Order of the rows of a group: smallest id, null ids last, then the place."""
    return F.struct(
        F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.col(locator).alias("locator")
    )


def advance(spark: SparkSession, folders: Folders, files_per_batch: int = 1000) -> None:
    """Feed what the log has gained to the keyed state; may be called again and again.

    Each micro-batch writes the groups it changed to a folder of its own, which a
    repeated batch overwrites, so a restart neither loses nor doubles a row.
    """
    log = spark.readStream.schema(spark.read.parquet(folders.log).schema).option(
        "maxFilesPerTrigger", files_per_batch
    )
    state = log.parquet(folders.log).groupBy("digest").agg(
        F.min(first_of()).alias("first"), F.count(F.lit(1)).alias("n")
    )

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folders.changes}/batch={batch}")

    wanted = {STATE: ROCKSDB, MEMORY: "true", MEMORY_MB: "100", UPKEEP: "15s", PREALLOCATE: "false", CHANGELOG: "true"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", folders.state)
            .trigger(availableNow=True)
            .foreachBatch(save)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()


def groups(spark: SparkSession, folders: Folders) -> DataFrame:
    """The groups as the state has them: (digest, first, n).

    The first row of a group only moves down and its count only up, so the last
    state is the least and the largest of all changes.
    """
    changes = spark.read.parquet(folders.changes)
    return changes.groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def differing(docs: DataFrame, found: DataFrame, digest=sha256, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows whose whole text is not that of their group's first row.

    Only members of groups of two or more move. A large group is cut into
    salted pieces, each with its own copy of the one text it is compared with.
    """
    text = normalised(text_of(text_col))
    hits = found.filter("n > 1").withColumn(
        "salts", F.ceil(F.col("n") / F.lit(MEMBERS_PER_COPY)).cast("int")
    )
    members = docs.select(
        F.col(id_col).alias("id"), F.input_file_name().alias("locator"), text.alias("body"), digest(text).alias("digest")
    )
    members = kept(members.join(hits, "digest"), "dedup-hits")
    is_first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("locator") == F.col("first.locator"))
    copies = (
        members.filter(is_first)
        .groupBy("digest", "salts")
        .agg(F.min("body").alias("first_body"))
        .select("digest", "first_body", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    )
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id", "locator"), F.col("salts")).cast("int"))
    return (
        salted.join(copies, ["digest", "salt"])
        .filter(F.col("body") != F.col("first_body"))
        .select("id", "locator", "digest", "body")
    )


def exact_dedup(docs: DataFrame, digest=sha256, id_col="doc_id", text_col="text", files_per_batch: int = 1000) -> DataFrame:
    """One row per document: (id, locator, digest, keep_id, group_size, kept).

    Of equal texts the smallest id stays; null ids come last, and of rows that
    repeat id and text one stays. Null and empty texts are equal. Two texts with
    one digest but different bytes are told apart.
    """
    spark = docs.sparkSession
    folders = Folders.below(scratch(spark, "dedup"))
    land(docs, folders, digest, id_col, text_col)
    advance(spark, folders, files_per_batch)
    found = kept(groups(spark, folders), "dedup-groups")
    odd = kept(differing(docs, found, digest, id_col, text_col), "dedup-odd")
    own = odd.groupBy("digest", "body").agg(F.min(first_of()).alias("own_first"), F.count(F.lit(1)).alias("own_n"))
    apart = odd.join(own, ["digest", "body"]).select(
        F.col("id").alias("odd_id"), F.col("locator").alias("odd_at"), F.col("digest").alias("odd_digest"), "own_first", "own_n"
    ).distinct()
    lost = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    rows = spark.read.parquet(folders.log).join(found, "digest")
    same = F.col("id").eqNullSafe(F.col("odd_id")) & (F.col("locator") == F.col("odd_at")) & (F.col("digest") == F.col("odd_digest"))
    rows = rows.join(apart, same, "left").join(lost, "digest", "left")
    first = F.coalesce("own_first", "first")
    size = F.coalesce("own_n", F.col("n") - F.coalesce("lost", F.lit(0)))
    rows = rows.select("id", "locator", "digest", first["id"].alias("keep_id"), size.alias("group_size"))
    return mark_kept(rows)


def mark_kept(rows: DataFrame) -> DataFrame:
    """kept: the row holds its group's id and is the first of the rows that repeat it.

    Rows are dealt by id, not by digest, so copies of one text lie apart again.
    """
    holds = F.col("id").eqNullSafe(F.col("keep_id"))
    # Rows without id are dealt by a part of their digest.
    near = Window.partitionBy("id", F.pmod(F.xxhash64("digest"), F.lit(1024))).orderBy("digest", "locator")
    first = ~F.col("digest").eqNullSafe(F.lag("digest").over(near))
    return rows.withColumn("kept", holds & first)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents less their exact copies, all columns as they were."""
    fate = kept(exact_dedup(docs, id_col=id_col, text_col=text_col), "dedup-fate")
    dropped = fate.filter(~F.col("kept")).select("id", "digest", F.col("id").eqNullSafe(F.col("keep_id")).alias("repeats")).distinct()
    digest = sha256(normalised(text_of(text_col)))

    def those(rows: DataFrame, how: str) -> DataFrame:
        return docs.join(rows, docs[id_col].eqNullSafe(rows["id"]) & (digest == rows["digest"]), how)

    plain = those(dropped, "left_anti")
    repeated = dropped.filter("repeats")
    if repeated.isEmpty():
        return plain
    # Rows that repeat id and text: one of them comes back.
    own = f"digest_of_{max(docs.columns, key=len)}"  # longer than any name of the documents
    again = those(repeated, "left_semi").withColumn(own, digest)
    return plain.unionByName(again.dropDuplicates([id_col, own]).select(*docs.columns))
