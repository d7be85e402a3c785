"""Filling fixed-capacity containers with documents by sum-of-squares packing.

A document's size is its number of UTF-8 bytes, which is its token count under the byte-level ByT5 tokenizer. Texts
larger than a container are cut into full pieces, which fill a container each, and a rest. Documents and rests are
dealt to groups of about ``GROUP_ITEMS`` items and packed there, larger items first: an item goes to the open container
for which the sum over residual gaps of the squared number of open containers with that gap becomes smallest (ties:
the smaller gap); a container is opened only if none has room. What a group leaves unused is that of its last few
containers, so the loss does not depend on the number of groups. ``plain`` takes the items in order of arrival instead
and lets opening a container compete with the others for the smallest sum.

Only ids and sizes are shuffled, never texts. Equal (id, size) rows are counted before they are dealt, so copies of
one document spread over all groups; many copies are cut into ranges of ``COPY_RANGE`` that are dealt to all tasks
before each range is counted out.

Defined results: null and empty texts have size 0 and take a place without using room; null ids are kept; rows that
share an id are numbered by ``copy_no``; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import cut

CAPACITY = 4096
#: Items packed by one task at a time; at 24 bytes each they fit any executor.
GROUP_ITEMS = 50_000
#: Copies of one document that one task numbers at a time.
COPY_RANGE = 10_000


def pack(sizes: np.ndarray, capacity: int = CAPACITY, plain: bool = False) -> np.ndarray:
    """The container number of each item, numbers counting from 0.

    ``plain`` keeps the items' order and opens a container where that makes the sum of squares smallest.
    """
    out = np.zeros(len(sizes), np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    opened = 0
    for at in range(len(sizes)) if plain else np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[at])
        if s == 0:
            out[at] = max(opened - 1, 0)
            continue
        have = count[s:]
        after = count[: capacity - s + 1]
        # moving a container from gap g to g - s changes the sum by 2 * (count[g - s] - count[g] + 1); a full one leaves the sum
        change = 2 * (after - have + 1)
        change[0] = 1 - 2 * have[0]
        fits = have > 0
        most = np.iinfo(np.int64).max
        # a new container with room left after the item adds 2 * count + 1, a full one nothing
        opening = most if not plain else 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        choice = np.where(fits, change, most)
        if fits.any() and choice.min() <= opening:
            left = int(choice.argmin())
            box = open_by_gap[s + left].pop()
            count[s + left] -= 1
        else:
            left, box = capacity - s, opened
            opened += 1
        out[at] = box
        if left:
            open_by_gap[left].append(box)
            count[left] += 1
    return out


def number_copies(counted: DataFrame, span: int = COPY_RANGE) -> DataFrame:
    """One row per copy, ``copy_no`` from 0. Rows with more than ``span`` copies are cut into ranges and dealt out first."""
    few = counted.where(F.col("copies") <= span).select("doc_id", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy_no"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(span).cast("long")))
    many = counted.where(F.col("copies") > span).select("doc_id", "size", "copies", starts.alias("first")).repartition("doc_id", "size", "first")
    upto = F.least(F.col("first") + span, F.col("copies")) - 1
    return few.unionByName(many.select("doc_id", "size", F.explode(F.sequence("first", upto)).alias("copy_no")))


def place_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, plain: bool = False) -> DataFrame:
    """Every piece of every document with its container.

    ``doc_id, copy_no, piece_no, n_pieces, byte_start, n_bytes, container_id``.
    """
    sizes = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("size"))
    counted = cut(sizes.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("copies")))
    total = counted.agg(F.sum("copies")).first()[0] or 0
    groups = max(1, -(-total // group_items))
    each = number_copies(counted)
    n_full = F.when(F.col("size") > capacity, F.floor(F.col("size") / capacity)).otherwise(0)
    rest = F.col("size") - n_full * capacity
    parts = each.select("*", n_full.alias("n_full"), rest.alias("rest")).withColumn("n_pieces", F.col("n_full") + F.when((F.col("rest") > 0) | (F.col("n_full") == 0), 1).otherwise(0))
    full = (
        parts.where("n_full > 0")
        .select("doc_id", "copy_no", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_full") - 1)).alias("piece_no"), "n_pieces")
        .select("doc_id", "copy_no", "piece_no", "n_pieces", (F.col("piece_no") * capacity).alias("byte_start"), F.lit(capacity).cast("long").alias("n_bytes"),
                F.concat_ws(":", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size", "copy_no", "piece_no").alias("container_id"))
    )
    items = parts.where("n_full < n_pieces").select(
        "doc_id", "copy_no", F.col("n_full").alias("piece_no"), "n_pieces", (F.col("n_full") * capacity).alias("byte_start"), F.col("rest").alias("n_bytes"),
        F.pmod(F.xxhash64("doc_id", "size", "copy_no"), F.lit(groups)).alias("grp"),
    )

    def run(key: tuple, pdf):
        order = ["doc_id", "copy_no"] if plain else ["n_bytes", "doc_id", "copy_no"]
        pdf = pdf.sort_values(order, ascending=[c != "n_bytes" for c in order], kind="stable")
        pdf["container_id"] = [f"pack:{key[0]}:{n}" for n in pack(pdf["n_bytes"].to_numpy(), capacity, plain)]
        return pdf.drop(columns="grp")

    packed = items.groupBy("grp").applyInPandas(run, "doc_id long, copy_no long, piece_no long, n_pieces long, byte_start long, n_bytes long, container_id string")
    return full.unionByName(packed)


def containers(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per container: ``container_id, n_items, used, free``."""
    return placed.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_bytes").alias("used")).withColumn("free", F.lit(capacity) - F.col("used"))
