"""Sharding by fixed virtual slots.

Every record hashes to one of ``n_slots`` slots for good. Bytes and rows are summed per
slot, and a versioned map says which shard holds each slot. Version 1 deals the slots
out by size, largest first, to the shard that is least full; growing edits the map so
that slots move only into the new shard. Only the map (``n_slots`` rows, a parameter)
is ever held in one place; the records meet it in a broadcast join.

Hot ids: an id (or no id) with more than ``HOT_ROWS`` rows would make its slot heavier than
a shard's share. Its rows are numbered once, in a stored table, and each hashes with its
number, so that they lie in all slots; no window or map entry then holds them all.

Cases: a null text counts no bytes; a null id is a key like any other; an empty table
gives an empty result and a map of empty slots; rows of one id share a slot up to
``HOT_ROWS`` and are numbered one after the other; extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.tables import joined_ids, stored

N_SLOTS = 4096
ROW_BYTES = 16
HOT_ROWS = 100          # rows of one id that may share a slot


def with_slots(df: DataFrame, key: list[Column], size: Column, n_slots: int = N_SLOTS) -> DataFrame:
    """``size`` and the record's permanent ``virtual_slot``."""
    return df.withColumns({
        "size": size.cast("long"),
        "virtual_slot": F.pmod(F.xxhash64(*key), F.lit(n_slots)).cast("int"),
    })


def spread_hot(slotted: DataFrame, key: str, hot_rows: int = HOT_ROWS, n_slots: int = N_SLOTS) -> DataFrame:
    """``slotted`` with the rows of every key over ``hot_rows`` spread over all slots.

    ``key`` is a column without nulls. The row numbers are stored before a slot hangs on
    them, so a task that runs again gives its rows the same slots.
    """
    numbered = stored(slotted.withColumn("row_number", F.monotonically_increasing_id()), "slotted")
    hot = numbered.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select(key, F.lit(True).alias("hot"))
    spread = F.pmod(F.xxhash64(key, "row_number"), F.lit(n_slots)).cast("int")
    return (joined_ids(numbered, hot, "left", key)
            .withColumn("virtual_slot", F.when(F.col("hot"), spread).otherwise(F.col("virtual_slot")))
            .drop("hot", "row_number"))


def slot_sizes(slotted: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """Rows and bytes of every slot, empty slots included."""
    spark = slotted.sparkSession
    sums = slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    every = spark.range(0, n_slots, 1, 1).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(sums), "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("rows", F.lit(0)).alias("rows"))


def first_map(sizes: DataFrame, n_shards: int) -> DataFrame:
    """Version 1 of the map: largest slot first, each to the least full shard.

    Ties go to the lower slot and the lower shard. Runs over the slots, never the rows.
    """
    slots = sizes.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("bytes")).alias("less"), F.col("virtual_slot").alias("virtual_slot"),
        F.col("rows").alias("rows")))).alias("slots"))
    dealt = slots.select(F.expr(f"""
        aggregate(slots,
            struct(array_repeat(0L, {n_shards}) AS load, cast(array() AS array<int>) AS shards),
            (a, s) -> named_struct(
                'load', transform(a.load, (x, i) ->
                    if(i = array_position(a.load, array_min(a.load)) - 1, x - s.less, x)),
                'shards', concat(a.shards,
                    array(cast(array_position(a.load, array_min(a.load)) - 1 AS int)))),
            a -> zip_with(slots, a.shards, (s, shard) -> named_struct(
                'virtual_slot', s.virtual_slot, 'bytes', -s.less, 'rows', s.rows, 'shard', shard)))
        """).alias("dealt"))
    return (dealt.select(F.explode("dealt").alias("d")).select("d.*")
            .withColumn("version", F.lit(1)))


def grown_map(slot_map: DataFrame, n_shards: int) -> DataFrame:
    """The next version of the map with shard ``n_shards`` added.

    Each old shard gives slots, smallest first, as long as it stays at or above the new
    mean; nothing moves between old shards.
    """
    by_shard = Window.partitionBy("shard")
    given = by_shard.orderBy("bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy()
    return (slot_map
            .withColumn("mean", F.sum("bytes").over(total) / (n_shards + 1))
            .withColumn("spare", F.sum("bytes").over(by_shard) - F.col("mean"))
            .withColumn("moved", (F.col("bytes") > 0) & (F.sum("bytes").over(given) <= F.col("spare")))
            .withColumn("shard", F.when(F.col("moved"), F.lit(n_shards)).otherwise(F.col("shard")))
            .withColumn("version", F.col("version") + 1)
            .drop("mean", "spare", "moved"))


def with_offsets(slot_map: DataFrame) -> DataFrame:
    """Where each slot's rows begin inside its shard."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    return slot_map.withColumn("first_position", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def assign(slotted: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """Records with ``shard`` and ``position``, gapless from 0 in each shard.

    Rows are numbered inside their virtual slot only, so no task sees a whole shard.
    """
    placed = F.broadcast(with_offsets(slot_map).select("virtual_slot", "shard", "first_position", "version"))
    inside = Window.partitionBy("virtual_slot").orderBy(*order)
    return (slotted.join(placed, "virtual_slot")
            .withColumn("position", F.col("first_position") + F.row_number().over(inside) - 1)
            .drop("first_position"))


def shard_documents(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS) -> tuple[DataFrame, DataFrame]:
    """Documents placed by version 1 of the map, and both stored versions of the map."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text) + F.lit(ROW_BYTES)
    slotted = with_slots(docs.select("doc_id", F.crc32(text).alias("text_crc32"), "text"),
                         [F.col("doc_id")], size, n_slots).drop("text")
    key = F.xxhash64("doc_id", F.col("doc_id").isNull())
    slotted = stored(spread_hot(slotted.withColumn("id_key", key), "id_key", n_slots=n_slots).drop("id_key"), "slotted")
    first = stored(first_map(slot_sizes(slotted, n_slots), n_shards), "slot-map-1")
    second = stored(grown_map(first, n_shards), "slot-map-2")
    grown = F.broadcast(second.select("virtual_slot", F.col("shard").alias("next_shard")))
    placed = assign(slotted, first, ["doc_id", "text_crc32", "size"]).join(grown, "virtual_slot")
    return placed, first.unionByName(second)
