import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.functions import kernels, models, paths, tensor
from framewright.operators import batches, monitor, pairing, sequence, sharding, shuffle
from framewright.streaming import windows as stream


def split(n, parts):
    """Contiguous parts whose sizes differ by one at most, larger first."""
    size, rest = divmod(n, parts)
    return [p for p in range(parts) for _ in range(size + (p < rest))]


@pytest.mark.parametrize(("n", "parts"), [(0, 3), (1, 3), (5, 4), (10, 3), (7, 7), (3, 8), (100, 9)])
def test_shards(spark, n, parts):
    rows = sharding.with_position(spark.range(n).withColumn("id", 3 * F.col("id")).repartition(5), "id", total="total")
    got = rows.select("id", "pos", sharding.balanced(F.col("pos"), F.col("total"), parts).alias("a"), sharding.by_ceiling(F.col("pos"), F.col("total"), parts).alias("b")).orderBy("id").collect()
    assert [r.pos for r in got] == list(range(n)) and [r.a for r in got] == split(n, parts)
    per = -(-n // parts) if n else 1
    assert [r.b for r in got] == [i // per for i in range(n)]
    both = sharding.two_levels(rows, 3, parts).orderBy("id").collect()
    nodes = split(n, 3)
    assert [r.node for r in both] == nodes
    assert [r.worker for r in both] == [w for k in range(3) for w in split(nodes.count(k), parts)]


def test_positions_with_ties_and_nulls(spark):
    rows = spark.createDataFrame([(None, 1), (2, 2), (2, 3), (None, 4)] * 20, "k long, v long")
    assert sorted(r.pos for r in sharding.with_position(rows, "k", "v").collect()) == list(range(80))


@settings(max_examples=200)
@given(st.integers(0, 200), st.integers(1, 40), st.integers(1, 6))
def test_chunks_cover_what_the_stride_keeps(n, size, stride):
    kept = list(range(0, n, stride))
    parts = [kept[i : i + size] for i in range(0, len(kept), size)]
    assert sum(parts, []) == kept and all(len(p) == size for p in parts[:-1])


def test_sequences(spark):
    frames = sequence.with_index(spark.createDataFrame([("a", t) for t in (5, 3, 9, 7, 1)] + [("b", 0)], "vid string, ts long"), ["vid"], ["ts"])
    assert [(r.vid, r.i, r.j) for r in sequence.keep_stride(frames, 2).orderBy("vid", "i").collect()] == [("a", 0, 0), ("a", 2, 1), ("a", 4, 2), ("b", 0, 0)]
    assert sequence.keep_after_skip(frames, 0).count() == 6
    with pytest.raises(ValueError):
        sequence.keep_stride(frames, 0)
    with pytest.raises(ValueError):
        tensor.frame_seconds(F.lit(1), 30, 31)
    got = sequence.windows(sequence.keep_stride(frames, 1), ["vid"], 2, 1, 30).orderBy("idx_in_vid").collect()
    assert [(r.idx_in_vid, r.start_frame, r.end_frame) for r in got] == [(0, -1, 1), (1, 1, 3)]
    offsets = spark.range(500).select(sequence.seeded_offset(F.col("id"), 4, 1).alias("o")).groupBy("o").count().collect()
    assert sorted(r.o for r in offsets) == [0, 1, 2, 3, 4] and min(r["count"] for r in offsets) > 60


def test_orders_are_permutations(spark):
    docs = sharding.with_position(spark.range(150).withColumnRenamed("id", "doc"), "doc", total="total")
    a, b = (shuffle.seeded_shuffle(docs.select("doc"), "doc", s).orderBy("pos").select("doc").toPandas().doc.tolist() for s in (1, 2))
    assert sorted(a) == sorted(b) == list(range(150)) and a != b
    blocks = shuffle.block_shuffle(docs, "doc", 40, 1).collect()
    assert sorted(r.shuffled for r in blocks) == list(range(150)) and all(r.shuffled // 40 == r.pos // 40 for r in blocks)
    assert shuffle.draws(docs, 1000, 3).groupBy("draw").count().where("count = 1").count() == 1000


def test_joins(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(2, "x"), (None, "y")], "k long, v string")
    assert sorted(str(r.k) for r in pairing.todo(a, b, ["k"]).collect()) == ["1", "None"]
    assert pairing.todo(a, b, ["k"], force=True).count() == 3
    assert [tuple(r) for r in pairing.paired(a, b, ["k"]).collect()] == [(2, "x")]
    assert [r.k for r in pairing.with_sibling(a, b, ["k"]).collect()] == [2]


def test_paths(spark):
    names = ["/a/b.c/x.jpg", "x", "/a/.hidden", "/a/b.c/x", "a/x_rgb.pt_rgb.pt", "/a/x.tar.gz", "/a/..x", "/a/\nb/c.jpg"]
    got = spark.createDataFrame([(n,) for n in names], "p string").select(
        paths.basename(F.col("p")), paths.dirname(F.col("p")), paths.strip_extension(F.col("p")), paths.swap_suffix(F.col("p"), "_rgb.pt", "_depth.pt")).collect()
    import os.path as op
    for n, r in zip(names, got, strict=True):
        assert tuple(r) == (op.basename(n), op.dirname(n), op.splitext(n)[0], n.replace("_rgb.pt", "_depth.pt"))
    assert spark.range(1).select(paths.padded(F.lit(1234567), 4)).first()[0] == "1234567"


def depth_bytes(x):
    x = np.asarray(x, np.float64)
    mad = np.abs(x - np.median(x)).mean()
    d = (x - np.median(x)) / mad if mad > 0 else np.zeros_like(x)
    return ((d - d.min()) / (d.max() - d.min() + 1e-8) * 255).astype(np.uint8)


def test_depth_bytes(spark):
    rng = np.random.default_rng(0)
    images = [rng.normal(size=n).tolist() for n in (64, 63, 1, 10)] + [[2.0] * 8]
    got = spark.createDataFrame([(i,) for i in images], "x array<double>").select(tensor.depth_to_bytes(F.col("x"))).collect()
    for image, r in zip(images, got, strict=True):
        assert np.abs(np.array(r[0]) - depth_bytes(image)).max() <= 1


def test_batches(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 5.0]), (2, [7.0, 7.0])], "pos long, x array<double>")
    got = {r.pos: r.scaled for r in batches.batch_to_bytes(rows, "x", 2).collect()}
    assert got[0] == [0, 63] and got[1] == [127, 255] and got[2] == [0, 0]
    padded = {r.pos: r.scaled for r in batches.batch_to_bytes(rows, "x", 2, include_padding=True).collect()}
    assert padded[2] == [255, 255]


def test_crop_and_kernels():
    assert tensor.crop_size(874, 1164) == (654, 1164) and tensor.crop_size(100, 400) == (100, 177)
    frame = np.random.default_rng(0).integers(0, 256, (9, 16, 3), np.uint8)
    for mode in ("half", "corners", "antialias"):
        assert np.array_equal(kernels.resize(frame, 9, 16, mode), frame)
        flat = kernels.resize(np.full((7, 5, 1), 9, np.uint8), 3, 8, mode)
        assert flat.shape == (3, 8, 1) and (flat == 9).all()
    corners = kernels.resize(frame, 4, 5, "corners")
    assert (corners[0, 0] == frame[0, 0]).all() and (corners[-1, -1] == frame[-1, -1]).all()


def test_kernels_agree_with_columns(spark):
    x = np.random.default_rng(1).normal(size=(8, 8))
    df = spark.createDataFrame([(x.ravel().tolist(),)], "x array<double>")
    for mode, corners in (("half", False), ("corners", True)):
        got = df.select(tensor.resize(F.col("x"), 8, 8, 5, 11, corners)).first()[0]
        assert np.allclose(got, kernels.resize(x[:, :, None], 5, 11, mode).ravel())


def test_padded_model_sees_whole_batches_only():
    seen = []

    def model(x):
        seen.append(x.shape)
        return x.reshape(len(x), -1)

    run = models.padded(model, (1, 2, 2), 4)
    x = np.arange(40, dtype=np.float32).reshape(10, 4)
    assert np.array_equal(run(x), x) and seen == [(4, 1, 2, 2)] * 3


def test_monitor(spark):
    got = monitor.interval_rates(spark.createDataFrame([(1, 10), (2, 25)], "t long, n long"), "t", "n", 5.0).orderBy("t").collect()
    assert (got[0].delta, got[1].delta, got[1].per_second) == (None, 15, 3.0)
    assert spark.range(1).select(monitor.rate(F.lit(5), F.lit(0.0))).first()[0] is None
    names = spark.createDataFrame([("a.JPG",), ("b.depth.jpg",), ("c.jpeg",), ("d.png",)], "path string")
    assert monitor.count_images(names).first()[0] == 3 and monitor.count_images(names, include_depth=False).first()[0] == 2


def test_windows_carry_over_between_batches(spark, tmp_path):
    rows = [(u, t * 10 + u, t) for t in range(40) for u in range(3)]
    for part in range(5):
        chunk = [r for r in rows if r[2] // 8 == part]
        spark.createDataFrame(chunk, "user_id long, event_id long, ts long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    frames = stream.read_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    got = stream.run_to_end(stream.count_windows(frames, "user_id", ["ts", "event_id"], "event_id", 6), "test")
    assert sorted((r.user_id, r.idx_in_vid, r.first_event, r.last_event) for r in got.collect()) == [
        (u, w, w * 60 + u, (w * 6 + 5) * 10 + u) for u in range(3) for w in range(6)]
    assert got.select("_batch").distinct().count() > 1
