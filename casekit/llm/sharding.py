"""Operator 10: sharding by fixed virtual slots (DataFrame / SQL only).

Every record hashes into one of ``VIRTUAL_SLOTS`` fixed slots.  Bytes are
aggregated per slot (a table of at most ``VIRTUAL_SLOTS`` rows, whatever the
input), and a versioned slot-to-shard map is laid over them: version 0 deals
the slots largest first to the lightest shard, later versions move only the
slots a rebalance needs.  Records never look at the map until they are
written, so an edit moves slots, not single records.  The query stores version
0 and the version with one more shard, and gives each record's place in both.

A record hashes by its id.  Records that repeat an id are told apart by the
text, and equal records by a row number given once, when the records are
stored: a hot id or row spreads over all slots like any other.

Defined results: a null text has no bytes; its size is the fixed record
overhead and its crc32 is that of the empty text.  A null doc_id hashes by
the text instead.  Repeated rows are separate records.  An empty table gives
an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casekit.llm.common import sized, stored, table
from casekit.plans.pipeline import scratch_path

VIRTUAL_SLOTS = 8192
OVERHEAD = 16
MAP = "version int, vslot bigint, shard int, bytes bigint, n bigint"


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            virtual_slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot): one row per record, stored.

    The slot comes from the md5 of the id, for repeated ids of id, text
    checksum and size, and for equal records of their row number, too.
    """
    text = f"encode(coalesce(`{text_col}`, ''), 'UTF-8')"
    rows = stored(docs.selectExpr(
        f"`{id_col}` AS doc_id",
        f"cast(octet_length({text}) + {OVERHEAD} as bigint) AS size",
        f"crc32({text}) AS text_crc32",
        "monotonically_increasing_id() AS __row"), "shard-rows")
    same = ["__id", "text_crc32", "size"]
    rows = rows.withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    # Counted map-side first, so a hot id costs a row a task.
    kinds = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("__n"))
    ids = kinds.groupBy("__id").agg(F.sum("__n").alias("__rows"), F.max("__n").alias("__most"))
    again = stored(ids.where("__rows > 1").select("__id", "__most"), "shard-repeats")
    key = ("concat_ws('|', __id, if(__most IS NOT NULL OR doc_id IS NULL, concat(text_crc32, '|', size), ''), "
           "if(__most > 1, cast(__row as string), ''))")
    return stored(
        rows.join(sized(again), "__id", "left").selectExpr(
            "doc_id", "size", "text_crc32",
            f"cast(conv(substr(md5({key}), 1, 8), 16, 10) as bigint) % {virtual_slots} AS vslot"),
        "shard-records")


def slot_bytes(recs: DataFrame) -> DataFrame:
    """(vslot, bytes, n): at most ``VIRTUAL_SLOTS`` rows, combined map-side."""
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def initial_map(slots: DataFrame, shards: int) -> DataFrame:
    """Version 0 of the slot map: (version, vslot, shard, bytes, n).

    Largest slot first onto the lightest shard (ties: the lowest shard), as
    one SQL fold over the slot list, which never exceeds ``VIRTUAL_SLOTS``.
    """
    fold = f"""
        aggregate(
          slots,
          named_struct('load', array_repeat(0L, {shards}), 'shard', cast(array() as array<int>)),
          (acc, s) -> named_struct(
            'load', transform(acc.load, (v, i) ->
                if(i = array_position(acc.load, array_min(acc.load)) - 1, v - s.neg, v)),
            'shard', concat(acc.shard,
                array(cast(array_position(acc.load, array_min(acc.load)) - 1 as int)))),
          acc -> arrays_zip(slots, acc.shard))"""
    # Ordered by size, largest first (neg), then by slot number.
    listed = slots.agg(F.expr(
        "array_sort(collect_list(named_struct('neg', -bytes, 'vslot', vslot, 'n', n))) AS slots"))
    return (
        listed.selectExpr(f"explode({fold}) AS e")
        .selectExpr("0 AS version", "e.slots.vslot AS vslot", "e.shard AS shard",
                    "-e.slots.neg AS bytes", "e.slots.n AS n")
    )


def add_shard(slot_map: DataFrame, new_shard: int) -> DataFrame:
    """Next version of the map, with one more shard.

    The fair share is found by water-filling: slots larger than the share of
    what is left are set aside with a shard each.  Slots go to the new shard
    largest first, as long as it stays within the fair share and the shard
    that gives does not fall below it.  Where slots are too coarse for that and
    the new shard has less than half its share, shards also give slots that
    leave them at least as full as the new one.  No slot moves between old
    shards.  Returns the whole map with ``version`` raised by one.
    """
    left = f"named_struct('bytes', cast(-sum_neg as bigint), 'open', {new_shard + 1}, 'go', true)"
    fair = f"""
        aggregate(slots, {left},
          (a, s) -> if(a.go AND -s.neg * a.open > a.bytes,
            named_struct('bytes', a.bytes + s.neg, 'open', a.open - 1, 'go', true),
            named_struct('bytes', a.bytes, 'open', a.open, 'go', false)),
          a -> a.bytes / a.open)"""
    load = (f"transform(sequence(0, {new_shard - 1}), i -> "
            "aggregate(slots, 0L, (a, s) -> if(s.shard = i, a - s.neg, a)))")

    def deal(start: str, moves: str) -> str:
        """One pass over the slots: which of them move, and the loads after it."""
        now = "(NOT a.moved[s.i] AND (" + moves + "))"
        return f"""
        aggregate(transform(slots, (s, i) -> named_struct('i', i, 'b', -s.neg, 'shard', s.shard)), {start},
          (a, s) -> named_struct(
            'load', transform(a.load, (v, i) -> if(i = s.shard AND {now}, v - s.b, v)),
            'taken', a.taken + if({now}, s.b, 0L),
            'moved', transform(a.moved, (m, i) -> if(i = s.i, m OR {now}, m))))"""

    start = ("named_struct('load', load, 'taken', 0L, 'moved', transform(slots, s -> false))")
    fine = "a.taken + s.b <= fair AND a.load[s.shard] - s.b >= fair"
    coarse = "a.taken < fair / 2 AND a.taken + s.b <= a.load[s.shard] - s.b"
    # The map is bounded by VIRTUAL_SLOTS, so one task may hold it; a null
    # version (an empty map) gives no rows.
    listed = slot_map.groupBy("version").agg(
        F.expr("array_sort(collect_list(named_struct('neg', -bytes, 'vslot', vslot, 'shard', shard, 'n', n)))"
               " AS slots"),
        F.expr("sum(-bytes) AS sum_neg"))
    dealt = (
        listed.selectExpr("version", "slots", f"{fair} AS fair", f"{load} AS load")
        .selectExpr("version", "slots", "fair", f"{deal(start, fine)} AS a")
        .selectExpr("version", "slots", f"{deal('a', coarse)} AS a")
    )
    return (
        dealt.selectExpr("version", "explode(arrays_zip(slots, a.moved)) AS e")
        .selectExpr("version + 1 AS version", "e.slots.vslot AS vslot",
                    f"if(e.moved, {new_shard}, e.slots.shard) AS shard",
                    "-e.slots.neg AS bytes", "e.slots.n AS n")
    )


def store_map(slot_map: DataFrame, path: str) -> None:
    """Append a version of the map to its Parquet history."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def latest_map(spark, path: str) -> DataFrame:
    """The newest stored version."""
    history = spark.read.schema(MAP).parquet(path)
    newest = history.agg(F.max("version").alias("version"))
    return history.join(F.broadcast(newest), "version")  # one row


def map_version(spark, path: str, version: int) -> DataFrame:
    """One stored version."""
    return spark.read.schema(MAP).parquet(path).where(f"version = {version}")


def assign(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with ``shard`` and ``slot``, the gapless position in the shard.

    A record's position is the number of records in the shard's earlier
    virtual slots plus its rank inside its own slot: the rank window covers
    one of thousands of slots, never a whole shard.
    """
    place = slot_map.select(
        "vslot", F.col("shard").cast("int").alias("shard"),
        (F.sum("n").over(Window.partitionBy("shard").orderBy("vslot")) - F.col("n")).alias("__base"))
    rank = F.row_number().over(
        Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    # At most VIRTUAL_SLOTS rows: a proven bound for the broadcast.
    return (
        recs.withColumn("__rank", rank)
        .join(F.broadcast(place), "vslot")
        .withColumn("slot", (F.col("__base") + F.col("__rank") - 1).cast("long"))
        .drop("__base", "__rank")
    )


def shard_documents(docs: DataFrame, shards: int = 40, virtual_slots: int = VIRTUAL_SLOTS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, vslot, shard, slot, rebalanced_shard) under the law ``bytes``.

    ``rebalanced_shard`` is the record's shard by the newest version of the
    map, where one more shard has taken its part of the slots.
    """
    spark = docs.sparkSession
    recs = records(docs, id_col, text_col, virtual_slots)
    path = scratch_path(spark, "slot-map")
    store_map(initial_map(slot_bytes(recs), shards), path)
    store_map(add_shard(latest_map(spark, path), shards), path)
    # By number: Spark takes reads of one folder for equal and would reuse the
    # newest version for an older listing.
    first = map_version(spark, path, 0)
    newest = latest_map(spark, path).selectExpr("vslot", "cast(shard as int) AS rebalanced_shard")
    # At most VIRTUAL_SLOTS rows: a proven bound for the broadcast.
    return assign(recs, first).join(F.broadcast(newest), "vslot")


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents into shards 0 to 39, sizes near equal."""
    out = shard_documents(table(spark, sf_dir, "documents"), 40)
    return out.selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' AS law", "shard", "slot",
        "cast(null as int) AS grown_shard", "vslot", "rebalanced_shard")
