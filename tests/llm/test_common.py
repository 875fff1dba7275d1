import random
import time

from pyspark.sql import functions as F

from framewright import storage
from framewright.llm import common
from framewright.llm.common import KeyFilter, connected_components, discard, materialise, shared_dir, small, spread_join


def roots(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    return {x: find(x) for x in up if find(x) != x}


def test_components(spark):
    rng = random.Random(0)
    chain = [(i, i + 1) for i in range(0, 70)]
    star = [(1000, 1000 + i) for i in range(1, 60)]
    noise = [(rng.randrange(2000, 2150), rng.randrange(2000, 2150)) for _ in range(90)] + [(-5, 7000), (7000, -5), (9, 9)]
    pairs = chain + star + noise
    rng.shuffle(pairs)
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == roots(pairs)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_key_filter_lets_all_its_keys_pass(spark):
    keys = spark.range(0, 5000, 7).select((F.xxhash64("id")).alias("key"))
    probe = spark.range(5000).union(spark.createDataFrame([(None,)], "id long"))
    got = KeyFilter(keys, "key", 20).flag(probe, F.xxhash64("id"), "maybe").where("id is not null").collect()
    assert all(r.maybe for r in got if r.id % 7 == 0) and sum(r.maybe for r in got) < 5000 / 7 + 60
    assert KeyFilter(keys, "key", 4).maps.count() == 1
    none = KeyFilter(keys.limit(0), "key").flag(probe, F.col("id"), "maybe")
    assert none.count() == 5001 and none.where("maybe").count() == 0


def test_small_is_checked(spark):
    df = materialise(spark.range(50), "numbers")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(small(df, 50)) and not hinted(small(df, 49))
    assert shared_dir(spark).startswith("file:")


def test_a_filter_has_bits_for_its_keys(spark):
    """Also beyond the bound: then the keys are taken in parts, and few strangers pass at any number of keys."""
    keys = spark.range(30_000).select(F.xxhash64("id").alias("key"))
    probe = spark.range(0, 3_000_000, 50)  # a fiftieth of it is there: 600 of 60,000
    for most, parts in ((29, 1), (16, 8)):
        made = KeyFilter(keys, "key", most_log_bits=most)
        assert made.parts == parts and made.bits == 1 << min(most, 19)
        got = [r.id for r in made.matching(probe, F.xxhash64("id")).collect()]
        assert len(got) == len(set(got)) and {i for i in got if i < 30_000} == set(range(0, 30_000, 50))
        assert len(got) < 600 + 60_000 / 8
    plan = made.matching(probe, F.xxhash64("id"))._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan  # rows stay where they are, in any number of passes


def test_hot_keys_are_dealt_to_many_tasks(spark, monkeypatch):
    """The join is that of any engine, and the rows of a hot key don't meet; null keys find no partner."""
    rows = spark.range(6000).selectExpr("if(id < 4000, 7L, if(id % 50 = 0, null, id % 40)) k", "id")
    keyed = materialise(rows.where("k is not null and k <> 11").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")), "keyed")
    want = {how: sorted(map(str, rows.join(keyed.drop("n"), "k", how).select("k", "id", "top").collect())) for how in ("inner", "left")}
    for bound in (10**9, 1000):
        monkeypatch.setattr(common, "HOT_ROWS", bound)
        for how, expected in want.items():
            got = spread_join(rows, keyed, ["k"], "n", how)
            assert sorted(got.columns) == ["id", "k", "top"] and sorted(map(str, got.select("k", "id", "top").collect())) == expected
    changed = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.shuffle.partitions": 50, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        dealt = spread_join(rows, keyed, ["k"], "n").withColumn("task", F.spark_partition_id()).where("k = 7").groupBy("task").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(dealt) > 20 and max(r["count"] for r in dealt) < 1000


def test_steps_are_deleted_when_told(spark):
    df = materialise(spark.range(5), "step")
    assert df.count() == 5
    discard(df)
    discard(df.select("id"))  # not written by itself: nothing to do
    fs = spark._jvm.org.apache.hadoop.fs.Path(df._framewright_path)
    assert not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)


def test_components_with_a_hub(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 50)
    pairs = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1040)]
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == roots(pairs)


def test_a_written_step_leaves_no_shuffle_files(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    out = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k"), "counts")
    end = time.time() + 20
    while shuffles() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffles() - before
    assert out.count() == 7 and spark.conf.get(storage.CLEANUP) == "false"


def test_writes_send_few_rows_at_once_to_python(spark):
    def lengths(batches):
        for batch in batches:
            yield batch.from_pydict({"rows": [batch.num_rows]})

    before = spark.conf.get(storage.BATCH)
    counts = [r.rows for r in materialise(spark.range(0, 25_000, 1, 2).mapInArrow(lengths, "rows long"), "batches").collect()]
    assert sum(counts) == 25_000 and max(counts) <= 1_000 and spark.conf.get(storage.BATCH) == before
    try:
        for said, most in (("300", 300), ("0", 1_000)):  # 0: no bound
            spark.conf.set(storage.BATCH, said)
            counts = [r.rows for r in materialise(spark.range(0, 5_000, 1, 1).mapInArrow(lengths, "rows long"), "batches").collect()]
            assert sum(counts) == 5_000 and max(counts) == most and spark.conf.get(storage.BATCH) == said
    finally:
        spark.conf.set(storage.BATCH, before)
