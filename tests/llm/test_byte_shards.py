import random
import zlib

from tests.llm.support import EDGES, documents
from textpulse.llm.byte_shards import balanced_shards


def check(spark, rows, shards):
    found = balanced_shards(documents(spark, rows).repartition(3), shards).collect()
    sizes = sorted(len((t or "").encode()) + 8 for _, t, _ in rows)
    assert sorted(r["size"] for r in found) == sizes
    crc = sorted((str(i), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.text_crc32) for r in found) == crc
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) <= set(range(shards))
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    target = sum(sizes) / shards
    for members in by_shard.values():
        assert abs(sum(r["size"] for r in members) - target) <= max(sizes)
    # Contiguous: in the order of shard and slot, ids rise.
    order = [r.doc_id or -1 for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    return found


def test_edge_rows(spark):
    check(spark, EDGES, 4)


def test_even_shards(spark):
    random.seed(3)
    rows = [(n, "x" * random.randrange(500), None) for n in range(800)]
    assert len({r.shard for r in check(spark, rows, 24)}) == 24


def test_one_hot_id(spark):
    rows = [(1, "same text", None)] * 300
    found = check(spark, rows, 24)
    counts = [sum(r.shard == s for r in found) for s in range(24)]
    assert max(counts) - min(counts) <= 1


def test_empty_table(spark):
    assert balanced_shards(documents(spark, []), 24).count() == 0
