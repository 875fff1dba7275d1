import os
import socket
import tarfile
import threading
import zipfile
from types import SimpleNamespace

import numpy as np
import pytest

from pyspark.sql import functions as F

from framewright.functions import codecs, kernels, models, tensor
from framewright.plans import jobs
from framewright.sources import archives, listing, settings
from framewright.streaming import ports, training
from framewright.streaming import windows as stream


def touch(root, *names, content=b"x"):
    for name in names:
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content)


def names(df, root, column="path"):
    return sorted(r[0].removeprefix("file:").removeprefix(str(root) + "/") for r in df.select(column).collect())


def test_listing(spark, tmp_path):
    touch(tmp_path, "a/1.mp4", "a/2.MP4", "b c/#x%20.mp4", "a/é|.mp4", "_hidden/3.mp4", ".dot/4.mp4", "a/_5.mp4", "a/n.txt")
    files = listing.list_files(spark, str(tmp_path))
    assert names(listing.videos(files), tmp_path) == ["a/1.mp4", "a/é|.mp4", "b c/#x%20.mp4"]
    assert len(names(listing.videos(files, "mp4", any_case=True), tmp_path)) == 4
    walked = listing.walk_files(spark, str(tmp_path))
    assert len(names(listing.videos(walked), tmp_path)) == 6
    assert listing.list_files(spark, str(tmp_path / "a"), str(tmp_path / "a")).count() == 2 * listing.list_files(spark, str(tmp_path / "a")).count()


def test_images_tensors_and_pairs(spark, tmp_path):
    touch(tmp_path, "10/000000/0000.jpg", "2/000000/0001.jpg", "2/000000/0000.jpg", "2/000000/0000.depth.jpg", "2/000001/1000.jpg", "x/000000/0000.jpg",
          "v/00000000_rgb.pt", "v/00000001_rgb.pt", "v/00000001_depth.pt", "v/00000002_rgb.pt", "v/00000002_depth.pt", "v/00000002_depthlatent.pt", "v/P.JPG", "v/P.depth.jpg")
    files = listing.list_files(spark, str(tmp_path))
    got = [r.path.rpartition(str(tmp_path) + "/")[2] for r in listing.indexed_images(files).collect()]
    assert got == ["2/000000/0001.jpg", "10/000000/0000.jpg"]
    assert listing.indexed_images(files, overwrite=True, most=None).count() == 4
    assert names(listing.tensors_without(files), tmp_path, "rgb") == ["v/00000000_rgb.pt"]
    assert names(listing.tensors_without(files, "_depthlatent.pt", needs="_depth.pt"), tmp_path, "rgb") == ["v/00000001_rgb.pt"]
    assert listing.tensors_without(files, force=True).count() == 3
    assert names(listing.image_pairs(files), tmp_path, "rgb_path") == ["2/000000/0000.jpg", "v/P.JPG"]


def test_dashcam_and_zip(spark, tmp_path):
    touch(tmp_path, "Chunk_1/b0|x/3/video.hevc", "Chunk_1/b0|x/3/other", "Other/a/3/video.hevc")
    got = listing.dashcam_segments(listing.list_files(spark, str(tmp_path))).collect()
    assert [(r.chunk, r.drive, r.segment) for r in got] == [("Chunk_1", "b0|x", "3")]
    for n in (1, 2):
        with zipfile.ZipFile(tmp_path / f"Chunk_{n}.zip", "w") as z:
            z.writestr("d/video.hevc", f"content {n}")
    got = listing.unzip_members(spark, str(tmp_path), ["Chunk_2.zip"]).collect()
    assert [(r.member, bytes(r.content)) for r in got] == [("d/video.hevc", b"content 1")]


def make_videos(root):
    rng = np.random.default_rng(0)
    os.makedirs(root)
    for name, n in (("a", 7), ("b", 4), ("c", 5)):
        with open(root / f"{name}.mp4", "wb") as f:
            np.save(f, rng.integers(0, 256, (n, 6, 8, 3), np.uint8))
    touch(root, "bad.mp4", content=b"no video")


def test_frames_to_images(spark, tmp_path):
    make_videos(tmp_path / "in")
    n = jobs.frames_to_images(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", frame_skip=1, workers=2, images_per_subdir=3)
    assert n == 4 + 2 + 3
    files = sorted(os.path.relpath(os.path.join(d, f), tmp_path / "out") for d, _, fs in os.walk(tmp_path / "out") for f in fs)
    assert files == ["0/000000/0000.png", "0/000000/0001.png", "0/000000/0002.png", "0/000001/0000.png", "0/000001/0001.png", "0/000001/0002.png",
                     "1/000000/0000.png", "1/000000/0001.png", "1/000000/0002.png"]
    assert (tmp_path / "out/0/000001/0001.png").read_bytes() == codecs.encode_png(np.load(tmp_path / "in/b.mp4")[0])
    jobs.frames_to_images(spark, str(tmp_path / "in"), f"file://{tmp_path}/raw", encode=lambda f: f.tobytes(), count=lambda p: 3, frame_skip=1, workers=1, ending=".jpg")
    assert jobs.count_images(spark, str(tmp_path / "raw")) == 6  # what containers say counts: two of three frames a video, none of a bad one
    assert (tmp_path / "raw/0/000000/0001.jpg").read_bytes() == np.load(tmp_path / "in/a.mp4")[2].tobytes()


def test_tensors_are_chunked_and_finished_videos_skipped(spark, tmp_path):
    make_videos(tmp_path / "in")
    out = str(tmp_path / "out")
    got = jobs.tensors_from_videos(spark, str(tmp_path / "in"), out, chunk_size=2, size=(3, 4), stride=2)
    assert sorted((os.path.basename(r.vid_path), r.split_ind, r.idx_in_split) for r in got.collect()) == [
        *(("a.mp4", i // 2, i % 2) for i in range(4)), *(("b.mp4", i // 2, i % 2) for i in range(2)), *(("c.mp4", i // 2, i % 2) for i in range(3))]
    assert jobs.tensors_from_videos(spark, str(tmp_path / "in"), out, chunk_size=2, size=(3, 4), stride=2).count() == 9


def test_rejects_are_rows(spark, tmp_path):
    make_videos(tmp_path / "in")
    got = listing.decoded_frames(listing.videos(listing.list_files(spark, str(tmp_path / "in"))), listing.numpy_video)
    assert got.where("error is not null").count() == 1
    with pytest.raises(ValueError):
        listing.decoded_frames(got, listing.numpy_video, 0)


def test_tars(spark, tmp_path):
    for i in range(23):
        touch(tmp_path / "in", f"d/{i}.jpg", content=f"rgb {i}".encode())
        if i % 5:
            touch(tmp_path / "in", f"d/{i}.depth.jpg", content=f"depth {i}".encode())
    jobs.shuffled_tars(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", images_per_tar=4, tars_per_subdir=2, ranks=2)
    seen = {}
    for d, _, fs in os.walk(tmp_path / "out"):
        for f in fs:
            with tarfile.open(os.path.join(d, f)) as tar:
                members = {m.name: tar.extractfile(m).read() for m in tar}
            for name, content in members.items():
                if not name.endswith(".depth.jpg"):
                    number = content.split()[1]
                    assert members[name.replace(".jpg", ".depth.jpg")] == b"depth " + number
                    seen[int(number)] = os.path.relpath(os.path.join(d, f), tmp_path / "out")
    assert sorted(seen) == [i for i in range(23) if i % 5]
    assert set(seen.values()) == {"0/0000/0000.tar", "0/0000/0001.tar", "0/0001/0000.tar", "1/0000/0000.tar", "1/0000/0001.tar", "1/0001/0000.tar"}


def test_a_failed_tar_job_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a.tar", "m", bytearray(b"x")), ("b.tar", None, bytearray(b"x"))], "key string, member string, content binary")
    with pytest.raises(Exception):  # noqa: B017
        archives.write_tars(rows, f"file://{tmp_path}/out")
    assert not [f for _, _, fs in os.walk(tmp_path / "out") for f in fs if not f.startswith(".")]


def test_png_files_are_read_by_spark(spark, tmp_path):
    rng = np.random.default_rng(1)
    frames = {f"{c}": rng.integers(0, 256, (5, 7, c), np.uint8) for c in (1, 3)}
    for name, frame in frames.items():
        touch(tmp_path, f"{name}.png", content=codecs.encode_png(frame))
    touch(tmp_path, "bad.png")
    assert listing.read_images(spark, str(tmp_path)).count() == 2
    for r in listing.read_images(spark, str(tmp_path), rejects=True).collect():
        name = r.origin.rpartition("/")[2][:-4]
        if name == "bad":
            assert r.error and r.pixels is None and r.height is None
        else:
            assert np.array_equal(np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, r.channels)[:, :, ::-1], frames[name])


def test_fixed_point_kernel_is_the_column_form(spark):
    rng = np.random.default_rng(2)
    frame = rng.integers(0, 256, (9, 6, 1), np.uint8)
    df = spark.createDataFrame([(frame.ravel().tolist(),)], "x array<int>")
    for to in ((4, 11), (9, 6), (20, 3)):
        got = df.select(tensor.fixed_point(F.col("x"), 9, 6, *to).alias("t")).first().t
        assert got == kernels.resize(frame, *to, "fixed").ravel().tolist()
        near = kernels.resize(frame.astype(float), *to)
        assert np.abs(np.array(got) - near.ravel()).max() < 1.01


def test_bfloat16(spark):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(0, 10, 500), 2.0 ** np.arange(-20, 20), -0.0, 1 + 2.0**-8, 1 + 3 * 2.0**-8].astype(np.float32)
    got = spark.createDataFrame([(x.astype(float).tolist(),)], "x array<double>").select(F.transform("x", tensor.to_bfloat16).alias("t")).first().t
    assert np.array_equal(np.array(got), kernels.to_bfloat16(x).astype(float))


def test_names_of_any_store():
    for name in ("/a b/#x%20.mp4", "file:/a b/#x%20.mp4", "file:///a b/#x%20.mp4"):
        fs, path = archives.open_store(name)
        assert path == "/a b/#x%20.mp4" and fs.type_name == "local"


def test_odd_names_are_read(spark, tmp_path):
    touch(tmp_path, "b c/#x%20é|.bin", content=b"12345")
    got = listing.per_file(listing.list_files(spark, str(tmp_path)), lambda p: [(len(archives.read_file(p)),)], "n long").collect()
    assert [(r.n, r.error) for r in got] == [(5, None)]


def test_windows_of_a_failing_video(spark, tmp_path):
    """The windows before the failure stand, and a row says why there are no more."""
    make_videos(tmp_path / "in")

    def decode(path):
        for i, frame in enumerate(listing.numpy_video(path)):
            if i == 5 and "a.mp4" in path:
                raise OSError("cut off")
            yield frame

    paths = listing.videos(listing.list_files(spark, str(tmp_path / "in")))
    got = stream.produce_windows(paths, decode, 2, 2, 30, (3, 4)).collect()
    found = {(r.vid_name, r.idx_in_vid, r.start_frame, r.end_frame, r.start_ts) for r in got if not r.error}
    assert found == {("a.mp4", 0, -2, 2, -2 / 15), ("b.mp4", 0, -2, 2, -2 / 15), ("c.mp4", 0, -2, 2, -2 / 15)}
    assert sorted((r.vid_name, r.error[:7]) for r in got if r.error) == [("a.mp4", "OSError"), ("bad.mp4", "ValueEr")]
    assert all(r.shape == [2, 3, 4, 3] and len(r.frames) == 72 for r in got if not r.error)
    with pytest.raises(ValueError):
        stream.produce_windows(paths, decode, 2, 31, 30)


def test_a_stream_takes_up_where_it_ended(spark, tmp_path):
    """A second run of the producer publishes only what has arrived since."""
    make_videos(tmp_path / "in")
    job = lambda: jobs.stream_windows(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), n_frames=4, resize_to=None)
    read = lambda: spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).where("error is null").count()
    job()
    assert read() == 1 + 1 + 1
    with open(tmp_path / "in/new.mp4", "wb") as f:
        np.save(f, np.zeros((9, 6, 8, 3), np.uint8))
    job()
    assert read() == 3 + 2


def test_depth_kernel_is_the_column_form(spark):
    rng = np.random.default_rng(5)
    for values in (rng.normal(0, 3, 24).tolist(), [2.0] * 24):
        want = spark.createDataFrame([(values,)], "x array<double>").select(tensor.depth_to_bytes(F.col("x")).alias("t")).first().t
        assert kernels.depth_bytes(np.array(values)).tolist() == want


def test_credentials_go_to_the_configuration_only(spark, tmp_path):
    text = "# comment\nexport AWS_ACCESS_KEY_ID = 'key'\nAWS_SECRET_ACCESS_KEY=\"a=b\"\n\nOTHER=1\n"
    assert settings.parse_settings(text) == {"AWS_ACCESS_KEY_ID": "key", "AWS_SECRET_ACCESS_KEY": "a=b", "OTHER": "1"}
    (tmp_path / "env").write_text(text)
    conf = spark._jsc.hadoopConfiguration()
    try:
        assert settings.apply_credentials(spark, str(tmp_path / "env"), {"AWS_ACCESS_KEY_ID": "ours"}) == ["fs.s3a.access.key", "fs.s3a.secret.key"]
        assert (conf.get("fs.s3a.access.key"), conf.get("fs.s3a.secret.key")) == ("ours", "a=b")
        assert settings.apply_credentials(spark, str(tmp_path / "none"), {}) == []
    finally:
        for name in settings.SETTINGS.values():
            conf.unset(name)


def test_accelerators_are_not_asked_for_on_a_local_master(spark):
    assert models.on_accelerators(spark) is None


def test_a_dashcam_chunk_is_cropped_and_numbered(spark, tmp_path):
    rng = np.random.default_rng(6)
    os.makedirs(tmp_path / "Chunk_1/d/3")
    with open(tmp_path / "Chunk_1/d/3/video.hevc", "wb") as f:
        np.save(f, rng.integers(0, 256, (5, 18, 16, 3), np.uint8))
    touch(tmp_path, "Chunk_1/d/4/video.hevc", content=b"junk")
    got = jobs.dashcam_chunks(spark, str(tmp_path), str(tmp_path / "out"), chunk_size=2, size=(3, 4)).collect()
    assert sorted((r.chunk, r.drive, str(r.segment), r.i, r.idx_in_chunk, len(r.pixels)) for r in got) == [("Chunk_1", "d", "3", i // 2, i % 2, 36) for i in range(5)]


def test_a_stream_from_ports(spark, tmp_path):
    """Two producers, one of which sends in pieces; every message comes once."""
    listening = [socket.create_server(("127.0.0.1", 0)) for _ in range(2)]

    def produce(k):
        connection, _ = listening[k].accept()
        with connection:
            for i in range(40):
                connection.sendall(f"{k}:{i}\n".encode() if k else f"{k}:".encode())
                if not k:
                    connection.sendall(f"{i}\n".encode())

    threads = [threading.Thread(target=produce, args=(k,), daemon=True) for k in range(2)]
    for t in threads:
        t.start()
    messages = ports.read_ports(spark, [s.getsockname()[1] for s in listening], workers=3, wait=0.5, queue=30)
    job = messages.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out"))
    try:
        for _ in range(60):
            job.processAllAvailable()
            got = sorted(r.message for r in spark.read.schema("message string").parquet(str(tmp_path / "out")).collect())
            if len(got) >= 80:
                break
    finally:
        job.stop()
        for s in listening:
            s.close()
    assert got == sorted(f"{k}:{i}" for k in range(2) for i in range(40))


def test_training_batches(spark, tmp_path):
    make_videos(tmp_path / "in")
    paths = listing.videos(listing.list_files(spark, str(tmp_path / "in")))
    windows = stream.produce_windows(paths, listing.numpy_video, 2, 1, 30)
    batches = list(training.WindowIterable(windows, 3, buffer=4, seed=1))
    assert [x.shape for x, _ in batches] == [(3, 2, 3, 6, 8), (3, 2, 3, 6, 8), (1, 2, 3, 6, 8)]
    seen = {(m["vid_name"], m["idx_in_vid"]): x for xs, ms in batches for x, m in zip(xs, ms)}
    assert len(seen) == 3 + 2 + 2
    frame = np.load(tmp_path / "in/a.mp4")[3]
    assert seen["a.mp4", 1].dtype == np.float32 and np.allclose(seen["a.mp4", 1][1], frame.transpose(2, 0, 1) / 255 * 2 - 1, atol=1e-6)
    assert len(list(training.WindowIterable(windows, 3, drop_last=True))) == 2
    order = [[m["idx_in_vid"] for m in ms] for _, ms in training.WindowIterable(windows, 3, buffer=4, seed=1)]
    assert order == [[m["idx_in_vid"] for m in ms] for _, ms in batches]


def test_depth_and_latents_of_tensors(spark, tmp_path):
    """From videos to tensors, depth and latents, by the command line's jobs; a second run finds nothing to do."""
    make_videos(tmp_path / "in")
    tensors, depths, latents = (str(tmp_path / x) for x in ("tensors", "depths", "latents"))
    jobs.tensors_from_videos(spark, str(tmp_path / "in"), tensors, chunk_size=4, size=(4, 6))
    model = jobs.named("framewright.functions.models:mean_depth")()
    depth = jobs.depth_from_tensors(spark, tensors, depths, model, (7, 9), 5).collect()
    assert len(depth) == 16 and all(len(r.depth) == 24 and 0 <= min(r.depth) and max(r.depth) <= 255 for r in depth)
    found = jobs.depthlatents_from_tensors(spark, tensors, depths, latents, models.block_means(2), 4, 5)
    assert {(r.vid_path, r.frame_idx) for r in found.collect()} == {(r.vid_path, r.frame_idx) for r in depth}
    assert all(len(r.latent) == 4 and abs(max(r.latent)) <= 1 for r in found.collect())
    assert jobs.depth_from_tensors(spark, tensors, depths, model, (7, 9), 5).count() == 16
    assert jobs.depthlatents_from_tensors(spark, tensors, depths, latents, models.block_means(2), 4, 5).count() == 16


def test_tasks_list_folders_and_the_driver_does_not(spark, tmp_path):
    touch(tmp_path, "v/00000000_rgb.pt", "v/00000001_rgb.pt", "v/00000001_depth.pt", "v/w/x/00000002_rgb.pt", "v/_x=1/3_rgb.pt", "v/_y/4_rgb.pt", "v/5_rgb.pt._COPYING_")
    touch(tmp_path, "v/6_rgb.pt", content=b"")
    os.symlink(tmp_path / "v/6_rgb.pt", tmp_path / "v/7_rgb.pt")
    os.symlink(tmp_path / "none", tmp_path / "v/8_rgb.pt")
    files = listing.list_files(spark, str(tmp_path))
    assert "binaryFile" not in files._jdf.queryExecution().toString()
    assert not any(f.startswith(f"file://{tmp_path}") for f in files.inputFiles())  # the driver holds none of the names
    assert names(listing.tensors_without(files), tmp_path, "rgb") == ["v/00000000_rgb.pt", "v/6_rgb.pt", "v/7_rgb.pt", "v/_x=1/3_rgb.pt", "v/w/x/00000002_rgb.pt"]
    one = listing.list_files(spark, f"{tmp_path}/v/0000000[01]_rgb.pt")  # a pattern
    assert names(one, tmp_path) == ["v/00000000_rgb.pt", "v/00000001_rgb.pt"]
    assert {r.path for r in one.collect()} <= {r.path for r in files.collect()}


def test_accelerators_are_asked_for_only_where_executors_have_them(monkeypatch):
    def on(master, **conf):
        context = SimpleNamespace(master=master, getConf=lambda: {k.replace("_", "."): v for k, v in conf.items()})
        return models.on_accelerators(SimpleNamespace(sparkContext=context))

    asked = []
    monkeypatch.setattr(models, "ResourceProfileBuilder", lambda: SimpleNamespace(require=lambda r: (asked.append(r), SimpleNamespace(build="profile"))[1]))
    assert on("spark://host:7077") is None
    assert on("yarn", spark_executor_resource_gpu_amount="0") is None
    assert on("local[4]", spark_executor_resource_gpu_amount="1") is None and not asked
    assert on("spark://host:7077", spark_executor_resource_gpu_amount="2") == "profile"
    assert [type(r).__name__ for r in asked] == ["TaskResourceRequests"]
