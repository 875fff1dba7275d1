import random

import pytest

from framewright.llm import sharding
from framewright.llm.sharding import ConflictError, Shard, ShardStore, shard_table


def make(spark, rows, schema="doc_id long, text string, shard string"):
    return spark.createDataFrame(rows, schema)


def test_arrivals_are_compacted_and_no_row_is_lost(spark, tmp_path):
    rows = [(i if i % 7 else None, f"text {i} " * (i % 50), "clash") for i in range(2000)] + [(5, "same", None)] * 3
    store, out = shard_table(make(spark, rows).repartition(8), arrivals=4, target_bytes=40_000, root=f"file://{tmp_path}/a")
    assert sorted(map(str, [(r.doc_id, r.text) for r in out.collect()])) == sorted(map(str, [r[:2] for r in rows]))
    version, shards = store.manifest()
    assert version > 4 and sum(s.rows for s in shards) == len(rows)
    assert store.read().columns == ["doc_id", "text", "shard"]
    assert len(shards) < 16 and not store.plan(shards)
    assert {r.shard_rows for r in out.collect()} == {s.rows for s in shards if s.rows}


@pytest.mark.parametrize("size", [200, 320, 350, 400, 500, 620, 630, 700, 749])
def test_shards_below_the_target_are_merged_to_it(spark, tmp_path, size):
    store = ShardStore(spark, f"file://{tmp_path}/t", target_bytes=1000)
    shards = [Shard(f"{i:03}", 1, size) for i in range(100)]
    while runs := store.plan(shards):
        gone = {s.path for r in runs for s in r}
        shards = [s for s in shards if s.path not in gone] + [Shard(r[0].path, len(r), sum(s.bytes for s in r)) for r in runs]
    assert sum(s.rows for s in shards) == 100 and all(s.bytes < 1500 for s in shards)
    left = [s.bytes for s in shards if s.bytes < 750]
    assert sum(left) < 750 and len(left) < 4
    assert not store.plan([Shard(str(i), 1, 200) for i in range(3)])  # too little yet: waits for a fourth


def test_versions_stay_readable_until_vacuum(spark, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/b", target_bytes=100_000, fan_in=2)
    for i in range(4):
        store.write(make(spark, [(i, "x" * 100, None)]), 1)
    assert store.read(2).count() == 2
    assert store.compact() == 5
    assert store.read().count() == 4 and store.read(4).count() == 4
    assert store.vacuum() == 4 and store.read().count() == 4
    assert store.compact() is None


def test_a_version_is_committed_once(spark, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/c")
    store._commit(1, [], set(), "first")
    with pytest.raises(ConflictError):
        store._commit(1, [], set(), "second")
    assert store.versions() == [1]


def test_a_compaction_that_comes_second_changes_nothing(spark, tmp_path, monkeypatch):
    """While one writer merges, another appends and compacts: the first gives way. After an append alone it goes on."""
    ours, theirs = (ShardStore(spark, f"file://{tmp_path}/race", target_bytes=100_000, fan_in=2) for _ in range(2))
    for i in range(4):
        ours.write(make(spark, [(i, "x" * 100, None)]), 1)
    found = ours._found

    def meanwhile(step):
        def run(folders):
            monkeypatch.setattr(ours, "_found", found)
            step()
            return found(folders)

        monkeypatch.setattr(ours, "_found", run)

    meanwhile(theirs.compact)
    assert ours.compact() is None and theirs.versions() == [1, 2, 3, 4, 5]
    assert ours.read().count() == 4 and len(ours.manifest()[1]) == 1
    ours.write(make(spark, [(8, "x" * 100, None)]), 1)
    meanwhile(lambda: theirs.write(make(spark, [(9, "x" * 100, None)]), 1))
    assert ours.compact() == 8
    assert sorted(r.doc_id for r in ours.read().collect()) == [0, 1, 2, 3, 8, 9]
    assert sorted(r.doc_id for r in theirs.read(7).collect()) == [0, 1, 2, 3, 8, 9]


def test_versions_across_snapshots(spark, tmp_path, monkeypatch):
    """Steps and whole lists give the same shards, also to a store that has seen none of it."""
    monkeypatch.setattr(sharding, "SNAPSHOT_EVERY", 5)
    rng, store, live, seen = random.Random(2), ShardStore(spark, f"file://{tmp_path}/steps"), {}, [set()]
    for version in range(1, 23):
        gone = set(rng.sample(sorted(live), min(len(live), rng.randrange(3))))
        new = [Shard(f"{version}-{i}", 1, 1) for i in range(rng.randrange(3))]
        store._commit(version, new, gone, "test")
        live = {p: s for p, s in live.items() if p not in gone} | {s.path: s for s in new}
        seen.append(set(live.values()))
    for version in rng.sample(range(23), 23):
        fresh = ShardStore(spark, f"file://{tmp_path}/steps")
        assert set(fresh.manifest(version)[1]) == set(store.manifest(version)[1]) == seen[version]


def test_the_plan_merges_all_that_can_be_merged(spark, tmp_path):
    """Runs are of one tier, found by a loop here, and large enough; what is left over is not."""
    rng, store = random.Random(4), ShardStore(spark, f"file://{tmp_path}/plan", target_bytes=1_000_000)

    def tier(size):
        out, top = 0, 750_000
        while size < top:
            out, top = out + 1, top / 4
        return out

    for _ in range(200):
        shards = [Shard(str(i), 1, int(10 ** rng.uniform(1, 6.2))) for i in range(rng.randrange(60))]
        runs = store.plan(shards)
        planned = [s for r in runs for s in r]
        assert len(planned) == len(set(planned))
        for r in runs:
            total = sum(s.bytes for s in r)
            assert len({tier(s.bytes) for s in r}) == 1 and tier(r[0].bytes) > 0 and total < 1_500_000
            assert len(r) >= 4 or len(r) > 1 and total >= 750_000
        left = [s for s in shards if s not in set(planned) and tier(s.bytes)]
        for t in {tier(s.bytes) for s in left}:
            rest = [s.bytes for s in left if tier(s.bytes) == t]
            assert len(rest) < 4 and (sum(rest) < 750_000 or len(rest) == 1)


def test_very_long_texts(spark, tmp_path):
    rows = [(i, "long " * (400_000 if i == 3 else 2), None) for i in range(8)]
    _, out = shard_table(make(spark, rows), target_bytes=50_000, root=f"file://{tmp_path}/long")
    assert sorted((r.doc_id, len(r.text)) for r in out.collect()) == sorted((i, len(t)) for i, t, _ in rows)


def test_orphans_are_not_read(spark, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/d")
    store.write(make(spark, [(1, "a", None)]), 1)
    make(spark, [(2, "b", None)]).write.parquet(f"file://{tmp_path}/d/data/left-behind")
    assert store.read().count() == 1
    assert store.vacuum() == 0 and store.vacuum(orphans=True) >= 1


def test_empty(spark, tmp_path):
    _, out = shard_table(make(spark, []), root=f"file://{tmp_path}/e")
    assert out.count() == 0 and "manifest_version" in out.columns
