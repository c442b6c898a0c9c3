"""Sharding by fixed virtual slots.

Every record hashes into one of ``SLOTS`` virtual slots.  Bytes and rows are aggregated per slot
(before the shuffle), and a slot map says which shard owns each slot.  The map is a table of fixed
size with versions: the first is built by giving the largest slot to the lightest shard, and later runs read the
newest version and edit single entries of it under the next one, until the shards are even again.

A record's slot is a hash of its text, so equal texts share a shard.  A group of copies that outweighs
``GROUP_SHARE`` of a shard cannot: its records are dealt over all slots by their id, and rows that also repeat the
id by their number among their equals.  Neither depends on how the table is partitioned.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablemill.llm.numbering import numbered
from tablemill.llm.scratch import shared_dir, store

SLOTS = 8192
SHARDS = 24
#: Of a shard's even share, what a group of equal texts may weigh and still stay together.
GROUP_SHARE = 0.5
#: Of a shard's even share, how far the heaviest and the lightest shard may be apart before a stored map is edited.
UNEVEN = 0.01


@dataclass(frozen=True)
class SlotMap:
    """owner[slot] is the shard of a virtual slot; ``version`` grows with every edit."""

    version: int
    shards: int
    owner: tuple[int, ...]

    def loads(self, weight: dict[int, int]) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.owner):
            out[shard] += weight.get(slot, 0)
        return out


def build_map(weight: dict[int, int], shards: int = SHARDS, slots: int = SLOTS) -> SlotMap:
    """Version 1: slots by falling weight, each to the lightest shard so far."""
    heap = [(0, s) for s in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-weight.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (load + weight.get(slot, 0), shard))
    return SlotMap(1, shards, tuple(owner))


def rebalance(old: SlotMap, weight: dict[int, int], shards: int | None = None, uneven: float = 0.0) -> SlotMap:
    """The next version for new weights or more shards; moves only slots that even out the loads, and none while
    the heaviest and lightest shard are no further apart than ``uneven`` of an even share."""
    shards = shards or old.shards
    if shards < old.shards:
        raise ValueError("a shard can be emptied only by a new map")
    owner = list(old.owner)
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        held[shard].append(slot)
    load = [sum(weight.get(s, 0) for s in own) for own in held]
    while True:
        high, low = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        fits = [s for s in held[high] if 0 < weight.get(s, 0) < gap]
        if not fits or gap <= uneven * sum(load) / shards:
            return SlotMap(old.version + 1, shards, tuple(owner))
        slot = min(fits, key=lambda s: (abs(2 * weight[s] - gap), s))
        held[high].remove(slot)
        held[low].append(slot)
        owner[slot] = low
        load[high] -= weight[slot]
        load[low] += weight[slot]


def store_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Add a version to the map table at ``path``.  Storing one again, as a repeated job does, changes nothing; another map
    under a version that is there is an error."""
    if slot_map.version in versions(spark, path):
        if load_map(spark, path, slot_map.version) != slot_map:
            raise ValueError(f"{path}: version {slot_map.version} is another map")
        return
    rows = [(slot_map.shards, slot, shard) for slot, shard in enumerate(slot_map.owner)]
    spark.createDataFrame(rows, "shards int, slot int, shard int").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={slot_map.version}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that are complete."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [n for n in names if n.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("version=")) for n in done)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """The given or newest version of the map table at ``path``."""
    version = version or versions(spark, path)[-1]
    rows = sorted(spark.read.parquet(f"{path}/version={version}").select("slot", "shard", "shards").collect())
    return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, whole: bool = False) -> DataFrame:
    """id, size (UTF-8 bytes plus 8), text_crc32, text_key, virtual_slot of each row, and if ``whole`` the row itself."""
    text = F.col(text_col).cast("string")
    data = F.coalesce(text, F.lit("")).cast("binary")
    key = F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text))
    own = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), key.alias("text_key"), *own)
    return rows.withColumn("virtual_slot", F.pmod("text_key", F.lit(slots)).cast("int"))


def slot_weights(rows: DataFrame) -> dict[int, int]:
    """Bytes per virtual slot: as many numbers as there are slots, whatever the input."""
    return {r["virtual_slot"]: r["b"] for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b")).collect()}


def heavy_texts(rows: DataFrame, weight: dict[int, int], shards: int) -> list[int]:
    """Keys of the texts whose copies outweigh what may stay together; fewer than shards / ``GROUP_SHARE``."""
    most = sum(weight.values()) * GROUP_SHARE / shards
    hot = [s for s, w in weight.items() if w > most]
    if not hot:
        return []
    groups = rows.filter(F.col("virtual_slot").isin(hot)).groupBy("text_key").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    return [r["text_key"] for r in groups.filter((F.col("b") > most) & (F.col("n") > 1)).collect()]


def deal(rows: DataFrame, heavy: list[int], slots: int) -> DataFrame:
    """``rows`` with the records of ``heavy`` texts dealt over all slots.

    Rows that repeat id and text are told by their number among their equals: the rows of a partition are numbered there, behind
    what earlier partitions hold, so neither a group nor its numbers pass through one task."""
    if not heavy:
        return rows
    is_heavy = F.col("text_key").isin(heavy)
    equal = ["id", "text_key", "size"]
    placed = store(rows.filter(is_heavy).withColumn("at", F.monotonically_increasing_id()), "heavy").withColumn("part", F.shiftright("at", 33))
    alike = lambda c: F.struct(F.col(c).isNull(), F.coalesce(c, F.lit(0)))
    many = placed.groupBy(*equal, "part").agg(F.count("*").alias("n"))
    before = many.select(*equal, "part", F.coalesce(F.sum("n").over(Window.partitionBy(*equal).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = placed.withColumn("number", F.row_number().over(Window.partitionBy(*equal, "part").orderBy("at"))).alias("x")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in (*equal, "part")]
    joined = own.join(before.alias("y"), same[0] & same[1] & same[2] & same[3])
    number = F.col("number") + F.col("before")
    dealt = F.pmod(F.xxhash64(alike("x.id"), F.col("x.text_key"), number), F.lit(slots)).cast("int")
    kept = [F.col(f"x.{c}") for c in rows.columns if c != "virtual_slot"]
    return rows.filter(~is_heavy).unionByName(joined.select(*kept, dealt.alias("virtual_slot")))


@dataclass(frozen=True)
class Plan:
    """A map and the texts whose copies are dealt: together they say where every row goes."""

    slot_map: SlotMap
    heavy: tuple[int, ...]


def plan_shards(rows: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> Plan:
    """The plan for ``rows`` of ``sized``.  With ``map_path`` the newest map there is taken and edited where it has become
    uneven (or has fewer shards), and the next version is stored; the first one is built."""
    spark = rows.sparkSession
    weight = slot_weights(rows)
    heavy = sorted(heavy_texts(rows, weight, shards))
    if heavy:
        weight = slot_weights(deal(rows, heavy, slots))
    known = versions(spark, map_path) if map_path else []
    if not known:
        made = build_map(weight, shards, slots)
    else:
        old = load_map(spark, map_path, known[-1])
        if len(old.owner) != slots:
            raise ValueError(f"{map_path}: the map has {len(old.owner)} slots, not {slots}")
        if old.shards > shards:  # a smaller number of shards is another map
            made = build_map(weight, shards, slots)
            made = SlotMap(old.version + 1, made.shards, made.owner)
        else:
            made = rebalance(old, weight, shards, UNEVEN)
            made = old if made.owner == old.owner and made.shards == old.shards else made
    if map_path:
        store_map(spark, made, map_path)
        made = load_map(spark, map_path, made.version)
    return Plan(made, tuple(heavy))


def place(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` of ``sized`` with their shard."""
    owner = plan.slot_map.owner
    table = rows.sparkSession.createDataFrame(list(enumerate(owner)), "virtual_slot int, shard int")
    return deal(rows, list(plan.heavy), len(owner)).join(F.broadcast(table), "virtual_slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", map_path: str | None = None) -> tuple[DataFrame, Plan]:
    """(rows with size, text_crc32, virtual_slot, shard, slot; the plan they follow).

    Law: the shards' bytes are near equal.  slot is the row's place in its shard (gapless from 0).  Rows of equal
    texts share a shard, unless they weigh more than half of one.  A null text has no bytes and the checksum of an empty
    one, and is equal to other null texts.  Rows that repeat an id, or have none, go by their texts like all others.
    No rows give no rows.  Other columns are ignored.
    """
    rows = store(sized(docs, id_col, text_col, slots), "sized")
    plan = plan_shards(rows, shards, slots, map_path)
    # Rows that are alike in all columns may be many: a number tells them apart, so that they can be dealt out.
    told = store(place(rows, plan), "placed").withColumn("alike", F.xxhash64(F.monotonically_increasing_id()))
    out = numbered(told, ["virtual_slot", "id", "text_crc32", "size", "alike"], "shard", "rows_of_shard")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "virtual_slot", "shard", F.col("position").alias("slot")), plan


def write_shards(docs: DataFrame, plan: Plan, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole documents to ``path``, one folder for each shard of the plan, as ``shard_documents`` says."""
    rows = place(sized(docs, id_col, text_col, len(plan.slot_map.owner), whole=True), plan)
    rows.select("row.*", "shard").write.partitionBy("shard").parquet(path)


def op7_virtual_slot_sharding(spark, sf_dir: str) -> DataFrame:
    # The table's map lasts as long as the shared folder does: a later run over the table edits it.
    path = f"{shared_dir(spark)}/tablemill/slot-maps/{hashlib.sha256(sf_dir.rstrip('/').encode()).hexdigest()[:32]}"
    rows, _ = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), map_path=path)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
