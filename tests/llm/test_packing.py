import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF
from weftline.llm import packing
from weftline.session import table


def test_pack_minimises_the_sum_of_squares():
    """Each placement against all choices, on random small cases."""
    rnd = random.Random(3)
    for _ in range(25):
        cap = rnd.choice([10, 17, 64])
        sizes = np.array([rnd.randrange(0, cap + 1) for _ in range(rnd.randrange(0, 40))], dtype=np.int64)
        boxes = packing.pack(sizes, cap)
        gaps: dict[int, int] = {}

        def total(g):
            return sum(n * n for x, n in Counter(g.values()).items() if x > 0)

        for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            s, b = int(sizes[at]), int(boxes[at])
            if s == 0:
                continue
            fits = [k for k, g in gaps.items() if g >= s]
            if not fits:
                assert b not in gaps
                gaps[b] = cap - s
                continue
            best = min((total({**gaps, k: gaps[k] - s}), gaps[k]) for k in fits)
            assert b in fits and (total({**gaps, b: gaps[b] - s}), gaps[b]) == best
            gaps[b] -= s


def test_places_everything_once_and_fills_well(spark):
    docs = table(spark, SF.replace("0.001", "0.01"), "documents")
    placed = packing.place_documents(docs, group_items=300)
    size = docs.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("size"))
    per = placed.groupBy("doc_id").agg(F.sum("n_bytes").alias("got"), F.max("n_pieces").alias("n"), F.count(F.lit(1)).alias("rows"))
    assert per.join(size, "doc_id").where("got <> size OR n <> rows OR (n > 1) <> (size > 4096)").count() == 0 and per.count() == size.count()
    boxes = packing.containers(placed)
    assert boxes.where("used > 4096 OR free < 0").count() == 0
    used, n = boxes.agg(F.sum("used"), F.count(F.lit(1))).first()
    assert used / (n * 4096) > 0.97


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "x" * 4096), (4, "é" * 4096), (4, "é" * 4096), (None, "abc"), (5, "x" * 100_001)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("grp", "size", "copies", "rest", "n_bytes")})
    out = packing.place_documents(df)
    by = {}
    for r in out.collect():
        by.setdefault((r["doc_id"], r["copy_no"]), []).append(r)
    assert len(by) == 7 and len(by[4, 1]) == 2 and len(by[3, 0]) == 1 and len(by[5, 0]) == 25
    assert sum(r["n_bytes"] for r in by[5, 0]) == 100_001 and by[1, 0][0]["n_bytes"] == 0
    assert packing.place_documents(df.where("false")).count() == 0


def test_plain_packing_lets_a_new_container_compete():
    """In order of arrival, opening counts as a choice: each placement against all of them."""
    rnd = random.Random(8)
    for _ in range(25):
        cap = rnd.choice([10, 17, 64])
        sizes = np.array([rnd.randrange(0, cap + 1) for _ in range(rnd.randrange(0, 40))], dtype=np.int64)
        gaps: dict[int, int] = {}
        total = lambda g: sum(n * n for x, n in Counter(g.values()).items() if x > 0)
        for s, b in zip(sizes.tolist(), packing.pack(sizes, cap, plain=True).tolist()):
            if s == 0:
                continue
            choices = {k: total({**gaps, k: g - s}) for k, g in gaps.items() if g >= s}
            choices[len(gaps)] = total({**gaps, len(gaps): cap - s})
            assert choices[b] == min(choices.values())
            gaps[b] = gaps.get(b, cap) - s


def test_many_copies_of_one_document_are_dealt_out(spark):
    counted = spark.createDataFrame([(1, 10, 90_000), (2, 20, 3), (None, 5, 10_001)], "doc_id long, size long, copies long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        out = packing.number_copies(counted, span=1_000)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 100_004 and max(sizes) < 30_000
    per = {r["doc_id"]: (r["n"], r["d"], r["lo"], r["hi"]) for r in out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("copy_no").alias("d"), F.min("copy_no").alias("lo"), F.max("copy_no").alias("hi")).collect()}
    assert per == {1: (90_000, 90_000, 0, 89_999), 2: (3, 3, 0, 2), None: (10_001, 10_001, 0, 10_000)}
