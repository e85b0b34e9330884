"""Shards of near-equal size by sampled splitters.

Plain DataFrame work. Records are ordered by the hash of their group (equal texts). A sample
drawn in proportion to size gives the splitters of fine ranges; ranges that turn out overfull,
because one group owns them, are subdivided by the record id. The exact bytes of all ranges
are known from one small aggregation, so a record's place in the whole is the start of its
range plus the bytes before it within the range, and the shard is that place divided by the
bytes per shard. Texts are read once and never shuffled.

Law ``bytes``: a shard differs from the mean by less than the largest record.

Defined cases: null text counts as no bytes and its checksum is that of empty text; nulls form a group
of their own. Null ids are one id. Rows equal in id and text are interchangeable. Shards may be
empty if there are fewer records than shards. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillweave.llm.common import input_rows, settled

SHARDS = 40
#: Overhead of a record besides its text.
RECORD_BYTES = 16
#: Keys sampled, and the square root of the number of ranges: splitters are looked up in two
#: steps of so many.
SAMPLE = 8192
FAN = 16


def sampled_splitters(records: DataFrame, sample: int = SAMPLE, fan: int = FAN) -> list[int]:
    """Quantile boundaries of column ``key`` by ``size``: at most fan * fan - 1, rising.

    The sample is weighted (each row draws an exponential time at rate ``size``, the earliest
    are taken) and bounded by ``sample``, whatever the number of rows. The draw depends on
    id and key alone, so it is the same in every run.
    """
    # The row's uniform number in (0, 1], from its hash.
    uniform = "(pmod(xxhash64('splitter', id, key), 9007199254740992) + 1) / 9007199254740992.0D"
    total = records.agg(F.sum("size")).first()[0] or 0
    # About twice the sample lies below this moment, so tasks hand on few rows beyond it.
    drawn = (
        records.selectExpr("key", f"-ln({uniform}) / size moment").where(F.col("moment") * total <= 2 * sample)
        .orderBy("moment").limit(sample)
    )
    keys = sorted(r.key for r in drawn.select("key").collect())
    step = len(keys) / (fan * fan)
    return sorted({keys[int(i * step)] for i in range(1, fan * fan)} if keys else set())


def _range_of(splitters: list[int], fan: int) -> str:
    """SQL for the number of splitters at or below ``key``, found in two steps."""
    if not splitters:
        return "0"
    groups = [splitters[i : i + fan] for i in range(0, len(splitters), fan)]
    heads = ", ".join(f"{g[0]}L" for g in groups[1:])
    tails = ", ".join("array(" + ", ".join(f"{k}L" for k in g) + ")" for g in groups)
    upper = f"size(filter(array({heads}), s -> s <= key))" if heads else "0"
    # g is bound once; the groups before it are full.
    return (
        f"transform(array({upper}), g -> g * {fan} + size(filter(get(array({tails}), g), s -> s <= key)))[0]"
    )


def shard_records(
    docs: DataFrame, shards: int = SHARDS, sample: int = SAMPLE, fan: int = FAN, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each record."""
    own = input_rows(docs, id=doc_id, text=text)
    records = settled(
        own.selectExpr(
            "id",
            f"cast(coalesce(octet_length(text), 0) + {RECORD_BYTES} as bigint) size",
            "crc32(cast(coalesce(text, '') as binary)) crc",
            "xxhash64(text) key",
        )
    )
    splitters = sampled_splitters(records, sample, fan)
    ranged = records.withColumn("r", F.expr(_range_of(splitters, fan)))
    totals = ranged.groupBy("r").agg(F.sum("size").alias("bytes"))
    # A range beyond twice its share is divided by the id; equal ids stay together.
    whole = Window.partitionBy(F.lit(0))  # a row per range: fan * fan at most
    parts = totals.select(
        "r", F.greatest(F.lit(1), F.floor(F.col("bytes") * fan * fan / F.sum("bytes").over(whole))).alias("parts")
    )
    # Both tables have a row per range: bounded by fan * fan and by twice that.
    fine = settled(
        ranged.join(F.broadcast(parts), "r").withColumn(
            "part", F.expr("if(parts < 2, 0L, pmod(xxhash64('part', id), parts))")
        ).select("id", "size", "crc", "key", "r", "part")
    )
    starts = fine.groupBy("r", "part").agg(F.sum("size").alias("bytes"))
    starts = starts.select(
        "r", "part", (F.sum("bytes").over(whole.orderBy("r", "part")) - F.col("bytes")).alias("start"),
        F.sum("bytes").over(whole).alias("total"),
    )
    inside = Window.partitionBy("r", "part").orderBy("key", "id", "size", "crc")
    placed = (
        fine.join(F.broadcast(starts), ["r", "part"])
        .withColumn("before", F.col("start") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        # The middle of the record decides: the first and the last shard gain no more than others.
        # Twice the bytes, to stay with whole numbers.
        .withColumn("shard", F.expr(f"cast((2 * before + size) * {shards} div (2 * total) as int)"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("r", "part", "shard").orderBy("key", "id", "size", "crc")))
        .select("id", "size", "crc", "r", "part", "shard", "nth")
    )
    placed = settled(placed)
    # A row per range and shard it reaches into: at most their sum.
    counts = placed.groupBy("shard", "r", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("r", "part")
    offsets = counts.select("shard", "r", "part", (F.sum("n").over(ahead) - F.col("n")).alias("ahead"))
    return placed.join(F.broadcast(offsets), ["shard", "r", "part"]).select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("ahead") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
