"""Sharding by fixed virtual slots.

Each record is hashed into one of a few thousand slots, which never change. Spark
adds up the bytes of each slot; a slot-to-shard map, stored by version, is all that
is edited when shards are rebalanced or added. Only the slot table (as long as the
number of slots, whatever the input) ever reaches the driver.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, shared_dir, table

N_SLOTS = 4096
N_SHARDS = 24
ROW_OVERHEAD = 8


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each slot; a map is never changed, only followed by another version."""

    version: int
    shard_of: tuple[int, ...]

    @property
    def n_shards(self) -> int:
        return max(self.shard_of) + 1

    @staticmethod
    def initial(n_slots: int = N_SLOTS, n_shards: int = N_SHARDS) -> SlotMap:
        return SlotMap(0, tuple(i % n_shards for i in range(n_slots)))

    def moved(self, other: SlotMap) -> list[int]:
        """The slots that another version holds elsewhere."""
        return [i for i, (a, b) in enumerate(zip(self.shard_of, other.shard_of)) if a != b]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, s) for i, s in enumerate(self.shard_of)]
        spark.createDataFrame(rows, "slot int, shard int").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={self.version}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """The version asked for, or else the latest one."""
        saved = spark.read.parquet(path)
        if version is None:
            version = saved.agg(F.max("version")).first()[0]
        rows = saved.filter(F.col("version") == version).select("slot", "shard").collect()
        return SlotMap(version, tuple(s for _, s in sorted(map(tuple, rows))))

    def rebalanced(self, slot_bytes: list[int], n_shards: int | None = None) -> SlotMap:
        """The next version, with nearly equal bytes in all shards.

        Slots of shards that are no more, if there are to be fewer, go first. Shards over the mean give up slots (the largest that still fits the excess
        first); those go, largest first, to whichever shard is lightest; single slots
        then move from the heaviest to the lightest shard while that narrows the gap.
        """
        n = n_shards or self.n_shards
        if len(slot_bytes) != len(self.shard_of):
            raise ValueError(f"{len(slot_bytes)} slots, but the map has {len(self.shard_of)}")
        held: list[list[int]] = [[] for _ in range(n)]
        pool: list[int] = []  # at first, the slots of shards that are given up
        for slot, shard in enumerate(self.shard_of):
            (held[shard] if shard < n else pool).append(slot)
        load = [sum(slot_bytes[i] for i in h) for h in held]
        mean = sum(slot_bytes) / n
        for s in range(n):
            held[s].sort(key=lambda i: (-slot_bytes[i], i))
            kept = []
            for i in held[s]:
                if slot_bytes[i] and load[s] > mean and (slot_bytes[i] <= load[s] - mean or i == held[s][-1]):
                    load[s] -= slot_bytes[i]
                    pool.append(i)
                else:
                    kept.append(i)
            while load[s] > mean and kept:
                small = min((i for i in kept if slot_bytes[i]), key=lambda i: slot_bytes[i])
                kept.remove(small)
                load[s] -= slot_bytes[small]
                pool.append(small)
            held[s] = kept
        lightest = [(load[s], s) for s in range(n)]
        heapq.heapify(lightest)
        for i in sorted(pool, key=lambda i: (-slot_bytes[i], i)):
            have, s = heapq.heappop(lightest)
            held[s].append(i)
            heapq.heappush(lightest, (have + slot_bytes[i], s))
        load = [sum(slot_bytes[i] for i in h) for h in held]
        for _ in range(4 * n):
            top, low = max(range(n), key=load.__getitem__), min(range(n), key=load.__getitem__)
            gap = load[top] - load[low]
            fits = [i for i in held[top] if 0 < slot_bytes[i] < gap]
            if not fits:
                break
            i = min(fits, key=lambda i: abs(gap - 2 * slot_bytes[i]))
            held[top].remove(i)
            held[low].append(i)
            load[top] -= slot_bytes[i]
            load[low] += slot_bytes[i]
        out = [0] * len(self.shard_of)
        for s, h in enumerate(held):
            for i in h:
                out[i] = s
        return SlotMap(self.version + 1, tuple(out))


def slotted(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each record's id, size, checksum and virtual slot, written once; texts go no further.

    The slot is a hash of these and, for records that are equal in them, of their number
    among their likes, so that many equal records are dealt to all slots. They are numbered
    within parts of the input, whose counts are then added up.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = ["size", "text_crc32"]
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialise(rows, "records")
    many = rows.groupBy("id", *key).agg(F.count("*").alias("n")).filter("n > 1").select(F.col("id").alias("many_id"), *(F.col(c).alias(f"many_{c}") for c in key))
    like = F.col("id").eqNullSafe(F.col("many_id")) & (F.col("size") == F.col("many_size")) & (F.col("text_crc32") == F.col("many_text_crc32"))
    many = materialise(many, "repeated")
    slot = lambda number: F.pmod(F.xxhash64("id", "text_crc32", "size", number), F.lit(n_slots)).cast("int").alias("virtual_slot")
    single = rows.join(many, like, "left_anti").select("id", *key, slot(F.lit(0).cast("long")))
    part = F.shiftright("row", 33).alias("part")  # of the input, as rows were numbered
    again = rows.join(many, like, "left_semi").select("id", *key, "row", part)
    counts = again.groupBy("id", *key, "part").agg(F.count("*").alias("n"))
    before = counts.select("id", *key, "part", (F.sum("n").over(Window.partitionBy("id", *key).orderBy("part")) - F.col("n")).alias("before"))
    before = before.select(F.col("id").alias("b_id"), *(F.col(c).alias(f"b_{c}") for c in [*key, "part"]), "before")
    numbered = again.withColumn("k", F.row_number().over(Window.partitionBy("id", *key, "part").orderBy("row")) - 1)
    same = F.col("id").eqNullSafe(F.col("b_id")) & (F.col("size") == F.col("b_size")) & (F.col("text_crc32") == F.col("b_text_crc32")) & (F.col("part") == F.col("b_part"))
    return materialise(single.union(numbered.join(before, same).select("id", *key, slot(F.col("before") + F.col("k")))).withColumnRenamed("id", id_col), "slots")


def slot_loads(slots: DataFrame, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot; at most n_slots rows come to the driver."""
    size, rows = [0] * n_slots, [0] * n_slots
    for r in slots.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r.virtual_slot], rows[r.virtual_slot] = r.b, r.n
    return size, rows


def shard(docs: DataFrame, map_dir: str, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put all rows of docs into shards of nearly equal bytes and number the places of each shard.

    map_dir keeps the versions of the slot map; where there is none, version 0 deals
    the slots out in turn, and the version made here follows the latest one, which must
    be of as many slots; shards may become more or fewer.

    Returns the id column, size (UTF-8 bytes of the text plus 8), text_crc32, law
    ('bytes'), shard, slot (a row's place in its shard, gapless from 0), grown_shard
    (null under this law) and virtual_slot. A null text counts as empty; a null id is
    a value like any other; repeated rows each get a place of their own,
    in any of the shards; an empty table gives no rows; other columns are ignored. Rows that tie take places by id
    and checksum.
    """
    spark = docs.sparkSession
    slots = slotted(docs, n_slots, id_col, text_col)
    size, rows = slot_loads(slots, n_slots)
    try:
        last = SlotMap.load(spark, map_dir)
    except AnalysisException as e:  # no map yet: no folder, or an empty one
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = SlotMap.initial(n_slots, n_shards)
        last.save(spark, map_dir)
    now = last.rebalanced(size, n_shards)
    now.save(spark, map_dir)
    first, seen = [], [0] * n_shards
    for i, s in enumerate(now.shard_of):
        first.append((i, s, seen[s]))
        seen[s] += rows[i]
    places = spark.createDataFrame(first, "virtual_slot int, shard int, first_place long")
    within = Window.partitionBy("virtual_slot").orderBy(id_col, "text_crc32", "size")
    return (
        slots.withColumn("place", F.row_number().over(within).cast("long") - 1)
        .join(F.broadcast(places), "virtual_slot")  # n_slots rows
        .select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first_place") + F.col("place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    return shard(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/slot_map-{uuid.uuid4().hex}")
