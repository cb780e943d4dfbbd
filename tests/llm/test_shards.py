from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from fleetlake.llm import queries, shards
from fleetlake.llm.shards import TOLERANCE, shard_by_bytes, write_shards


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string")


def held(rows, docs, shards):
    """The laws that hold for any input."""
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, _ in docs)
    slots = defaultdict(list)
    size = Counter()
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 16
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / shards
    most = max((r.size for r in rows), default=0)
    assert all(abs(size[s] - mean) <= 2 * (TOLERANCE * mean + most) for s in range(shards))


def test_near_equal_and_groups_together(spark):
    rng = random.Random(1)
    docs = [(i, "wörd " * rng.randint(0, 40) + str(rng.random()), "old") for i in range(4000)]
    docs += [(i, f"copy {i % 500}", "old") for i in range(4000, 5000)]
    rows = shard_by_bytes(frame(spark, docs), 7).collect()
    held(rows, docs, 7)
    homes = defaultdict(set)
    for r in rows:
        homes[r.text].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 6
    assert {r.shard_ for r in rows} == {"old"}


def test_hot_group_and_repeated_rows_are_split(spark):
    docs = [(i, "the same text", None) for i in range(2000)] + [(7, "one row again and again", None)] * 2000
    docs += [(i, None, None) for i in range(20)] + [(None, "", None)] * 3
    rows = shard_by_bytes(frame(spark, docs), 10).collect()
    held(rows, docs, 10)
    assert len({r.shard for r in rows}) == 10


@pytest.mark.parametrize("docs", [[], [(1, "only", None)], [(1, None, None), (None, None, None)]])
def test_few_rows(spark, docs):
    rows = shard_by_bytes(frame(spark, docs), 5).collect()
    assert len(rows) == len(docs)
    assert all(0 <= r.shard < 5 for r in rows)


def test_very_long_text(spark):
    docs = [(0, "x" * 500_000, None)] + [(i, f"t{i}", None) for i in range(1, 50)]
    held(shard_by_bytes(frame(spark, docs), 3).collect(), docs, 3)


def test_query_moves_whole_documents(spark, monkeypatch, tmp_path):
    sharded = []

    def kept(*args, **named):
        sharded.append(shard_by_bytes(*args, **named))
        return sharded[0]

    monkeypatch.setattr(queries, "shard_by_bytes", kept)
    sf = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op10_sharding"].run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert set(docs.columns) < set(sharded[0].columns)
    write_shards(sharded[0], str(tmp_path / "shards"))
    written = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(written.select(*docs.columns).collect()) == Counter(docs.collect())
    placed = {(r.doc_id, zlib.crc32(r.text.encode()) if r.text is not None else None, r.shard, r.slot) for r in written.collect()}
    assert {(r.doc_id, r.text_crc32, r.shard, r.slot) for r in rows} == placed


def test_many_bytes_take_more_tasks_than_shards(spark, monkeypatch):
    monkeypatch.setattr(shards, "BYTES_PER_TASK", 5_000)
    docs = [(i, f"text {i} " * 20, None) for i in range(500)]
    held(shard_by_bytes(frame(spark, docs), 3).collect(), docs, 3)


def _signed(raw, seed=42):
    value = xxhash.xxh64_intdigest(raw, seed)
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize("few", [0, shards.FEW_STARTS])
def test_places_as_in_one_sorted_list(spark, monkeypatch, few):
    """All rows sorted by the hashes of text and id, cut where the running bytes pass each shard's share."""
    monkeypatch.setattr(shards, "FEW_STARTS", few)
    rng = random.Random(6)
    docs = [(i, f"text {i % 700} " * rng.randint(1, 60), None) for i in range(3000)]
    rows = shard_by_bytes(frame(spark, docs), 9).collect()
    ordered = sorted(rows, key=lambda r: (_signed(r.text.encode()), _signed(r.doc_id.to_bytes(8, "little"))))
    shard, slot, passed = 0, 0, 0
    total = sum(r.size for r in rows)
    for r in ordered:
        if r.shard != shard:
            assert r.shard == shard + 1
            assert abs(passed - total * r.shard / 9) <= TOLERANCE * total / 9 + max(x.size for x in rows)
            shard, slot = r.shard, 0
        assert r.slot == slot
        slot, passed = slot + 1, passed + r.size
    assert shard == 8
