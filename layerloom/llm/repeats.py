"""What the two substring operators share: which anchored places of a corpus have equals elsewhere.

An anchor is a place that the text around it chooses, so equal passages choose equal places. It carries ``key``, a hash of the part of its
surroundings that every repeated window around it contains, and ``context``, a hash of all the surroundings that matter to it. Anchors with an equal context are
settled: whatever lies around them is repeated as far as it matters. What is left is one row per distinct context of a key that has several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerloom.llm.common import whole_text, written

# Document keys, at most, that are sent to every task (16 bytes each) in place of a shuffle of the texts.
KEYS_SENT = 1_000_000
DOCUMENT = ["doc_id", "text_key"]


def keyed_texts(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text, and a hash of the text: rows with equal ids and different texts are told apart, equal rows are treated alike."""
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return texts.withColumn("text_key", F.xxhash64("text", "doc_id"))


def restricted(texts: DataFrame, wanted: DataFrame, others: bool = False) -> DataFrame:
    """The texts of the wanted documents, or all others. Few keys are sent to the texts; beyond the bound both sides are shuffled."""
    keys = written(wanted.select("text_key").distinct(), "wanted-texts")
    few = keys.count() <= KEYS_SENT
    return texts.join(F.broadcast(keys) if few else keys, "text_key", "left_anti" if others else "left_semi")


def settle(anchors: DataFrame, payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """(settled, open) of a stored table with doc_id, text_key, key, context and the payload columns.

    settled: doc_id, text_key, payload of every anchor whose context occurs at another place too. open: the same with key and ``alone``, one row for
    each distinct context of the keys that have several contexts, one of them occurring once (alone) at least. Counts are combined before
    every shuffle, so a common key costs a row per task.
    """
    several = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    shared = written(anchors.join(several, "key", "left_semi"), "shared-anchors")
    place = F.struct(*DOCUMENT, *payload)
    contexts = written(shared.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")), "contexts")
    repeated = contexts.where("n > 1").select("key", "context")
    settled = shared.join(repeated, ["key", "context"], "left_semi").select(*DOCUMENT, *payload)
    mixed = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("contexts"), F.count_if(F.col("n") == 1).alias("alone"))
    mixed = mixed.where("contexts > 1 and alone > 0").select("key")
    left = contexts.join(mixed, "key", "left_semi").select("key", (F.col("n") == 1).alias("alone"), "first.*")
    return settled, left


def merged(starts, stops) -> list[tuple[int, int]]:
    """The union of half-open ranges as sorted, separate ranges; touching ones are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts, stops)):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
