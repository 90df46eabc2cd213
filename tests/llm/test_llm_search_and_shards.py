"""Exact top-k search and sharding against brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_cases import frame, texts
from pyspark.sql import functions as F

from folioflow.llm.exact_topk import exact_topk
from folioflow.llm.sharding import Node, assign_shards, even_tree, grown, number_rows, shard_of

VECTORS = "vec_id long, embedding array<float>, label int, score string, _block int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)


def brute(rows, queries, k):
    held = {(i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, w in held:
        if q in queries:
            scores = sorted((-sum(a * b for a, b in zip(w, c)), i) for i, c in held if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [7, 10_000])
def test_topk_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(60)]
    rows += [(100 + i, rows[4][1]) for i in range(20)]  # ties
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (204, [0.0] * 6), (205, []), (206, [1.0, 2.0]), rows[0], rows[0]]
    df = vectors(spark, rows)
    got = exact_topk(df, df.where("vec_id % 20 = 0"), k=10, block_rows=block_rows)
    asked = {i for i, _ in rows if i is not None and i % 20 == 0}
    assert sorted(map(tuple, got.collect())) == brute(rows, asked, 10)


def test_topk_of_little(spark):
    df = vectors(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5])])
    assert [tuple(r) for r in exact_topk(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, 512 * 1024 + 512 * 2048)]
    empty = vectors(spark, [])
    assert exact_topk(empty, empty).count() == 0
    assert exact_topk(df, empty).count() == 0


def test_shards_are_even_and_move_only_into_the_new_one(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = even_tree()
    got = assign_shards(docs, tree, grown(tree, 8)).toPandas()
    counts = Counter(got["shard"])
    assert set(counts) == set(range(8)) and max(counts.values()) < 1.1 * 20_000 / 8
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) == {8} and 0.08 < len(moved) / len(got) < 0.14


def test_weights_set_shares_and_confine_movement(spark):
    def tree(weight):
        left = Node("a", (Node("a/0", shard=0), Node("a/1", shard=1, own_weight=weight)))
        return Node("", (left, Node("b", (Node("b/0", shard=2), Node("b/1", shard=3)))))

    docs = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    got = docs.select(shard_of(tree(1.0), F.col("k")).alias("x"), shard_of(tree(3.0), F.col("k")).alias("y")).toPandas()
    share = Counter(got["y"])
    assert abs(share[1] / 20_000 - 0.5) < 0.02 and abs(share[2] / 20_000 - 1 / 6) < 0.02
    # Rows move only into the region whose weight grew; within it only into the heavier shard.
    moved = got[got["x"] != got["y"]]
    assert set(moved["y"]) <= {0, 1}
    assert set(got[got["x"].isin([0, 1]) & (got["x"] != got["y"])]["y"]) == {1}


@pytest.mark.parametrize("bucket_rows", [5, 1000])
def test_numbers_are_gapless_whatever_the_buckets(spark, bucket_rows):
    docs = frame(spark, texts()).select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"))
    many = docs.unionByName(spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("crc")))
    sharded = assign_shards(many, even_tree()).drop("grown_shard")
    got = number_rows(sharded, "shard", "doc_id", ["doc_id", "crc", "shard"], bucket_rows).toPandas()
    assert len(got) == many.count()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    other = number_rows(sharded, "shard", "doc_id", ["doc_id", "crc", "shard"], 50).toPandas()
    key = ["doc_id", "crc", "shard", "slot"]
    assert sorted(map(repr, got[key].itertuples(index=False))) == sorted(map(repr, other[key].itertuples(index=False)))


def test_query_digests(spark, tmp_path):
    from folioflow.llm.sharding import op9_hash_tree_sharding

    frame(spark, texts()).write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_hash_tree_sharding(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op9_hash_tree_sharding(spark, f"{tmp_path}/none").count() == 0
