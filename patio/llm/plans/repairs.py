"""Repaired conversations."""

from pyspark.sql import functions as F

from patio.llm.common import table
from patio.llm.conversations import conversation_digests, conversation_key, repair_conversations


def damaged(conversations):
    """Rows dropped, emptied, cut, repeated or given to the user by a checksum of conversation and turn."""
    def spaced(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = (F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(spaced("text"), "[.!?]", ""))
            .otherwise(spaced("text")))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.withColumn("fate", fate).filter("fate != 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op11_conversation_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair_conversations(damaged(given))
    ids = given.select("conv_id").distinct().withColumn("conv", conversation_key("conv_id"))
    out = ids.join(fixed.conversations, "conv", "left").join(conversation_digests(fixed.rows), "conv", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
ORACLES = {}
