"""The jobs of the command line, each one lineage from listing to files."""

from __future__ import annotations

import argparse
import importlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import kernels, models, paths, tensor
from ..functions.codecs import encode_png
from ..operators import batches, monitor, pairing, sharding, shuffle
from ..sources import archives, listing, settings
from ..storage import materialise
from ..streaming import windows as stream


def frames_to_images(
    spark: SparkSession, root: str, out: str, decode: Callable = listing.numpy_video, encode: Callable = encode_png, count: Callable | None = None,
    frame_skip: int = 30, workers: int = 8, suffix: str = "mp4", images_per_subdir: int = 1000, layout: str = "worker", ending: str = ".png",
) -> int:
    """Every frame after `frame_skip` left out, as image files; returns their number.

    Layouts: "worker" is ``<out>/<worker>/<folder>/<number>``, numbers running over all kept frames of a worker's
    videos in the order of paths; "video" has the video's position for the worker and numbers of its own;
    "flat" is ``<out>/<video>/<number>`` without folders. `encode` turns a frame into the bytes of a file, whose
    names end in `ending`; PNG needs no library.

    A video's place follows from the frame counts of those before it, so pixels go from the decoder to their file
    and are never moved or sorted. `count` gives a video's frames by path, as containers know them; without it
    a first pass decodes. A video that fails keeps the frames it did give.
    """
    found = listing.videos(listing.list_files(spark, root), suffix, any_case=True)
    found = sharding.with_position(found.select("path"), "path", total="total")
    found = found.withColumn("worker", sharding.balanced(F.col("pos"), F.col("total"), sharding.clamped(workers, F.col("total"))))
    step = frame_skip + 1

    def frames(path: str) -> Iterator:
        try:
            yield from decode(path)
        except Exception:  # the frames before it stand; listing.decoded_frames keeps the reason
            return

    def counted(path: str) -> list[tuple]:
        n = count(path) if count else sum(1 for _ in frames(path))
        return [(-(-n // step),)]

    spread = max(1, 4 * workers)
    counts = materialise(listing.per_file(found.repartition(spread, "path"), counted, "n long").select("path", F.coalesce("n", F.lit(0)).alias("n")), "frame-counts")
    placed = found.join(counts, "path").withColumn("first", F.lit(0).cast("long"))
    if layout == "worker":  # a row a video
        placed = placed.withColumn("first", F.sum("n").over(Window.partitionBy("worker").orderBy("pos")) - F.col("n"))
    placed = placed.withColumn("number", F.col("worker") if layout == "worker" else F.col("pos"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = archives.open_store(out)
        for batch in batches:
            for row in batch.to_pylist():
                kept = 0
                for i, frame in enumerate(frames(row["path"])):
                    if i % step == 0 and kept < row["n"]:
                        g = row["first"] + kept
                        place = f"{g:06d}" if layout == "flat" else f"{g // images_per_subdir:06d}/{g % images_per_subdir:04d}"
                        archives.store(fs, f"{folder}/{row['number']}/{place}{ending}", encode(frame))
                        kept += 1
                yield pa.RecordBatch.from_arrays([pa.array([kept], pa.int64())], ["kept"])

    written = placed.select("path", "number", "first", "n").repartition(spread, "path").mapInArrow(write, "kept long")
    return written.groupBy().sum("kept").first()[0] or 0


def shuffled_tars(
    spark: SparkSession, root: str, out: str, images_per_tar: int = 1000, tars_per_subdir: int = 100, ranks: int = 8, seed: int = 42, prefix: str = "",
) -> DataFrame:
    """Image and depth pairs, shuffled, to archives ``<prefix><rank>/<folder>/<number>.tar``; returns the addresses.

    Names are shuffled; contents are read by the task that writes their archive, and no other file is opened.
    """
    pairs = shuffle.seeded_shuffle(listing.image_pairs(listing.list_files(spark, root)), "rgb_path", seed, total="total")
    pairs = pairs.withColumn("rank", sharding.balanced(F.col("pos"), F.col("total"), ranks))
    size, rest = F.floor(F.col("total") / ranks), F.col("total") % ranks
    p = F.col("pos") - (F.col("rank") * size + F.least("rank", rest))
    tar = F.floor(p / images_per_tar).cast("long")
    key = F.concat(F.lit(prefix), paths.padded(F.col("rank"), 1), F.lit("/"), paths.padded(F.floor(tar / tars_per_subdir).cast("long"), 4),
                   F.lit("/"), paths.padded(tar % tars_per_subdir, 4), F.lit(".tar"))
    placed = pairs.select("rgb_path", "depth_path", key.alias("key"), (p % images_per_tar).alias("member"))
    both = placed.select("key", F.explode(F.array(
        F.struct(F.col("rgb_path").alias("source"), F.concat(paths.padded(F.col("member"), 4), F.lit(".jpg")).alias("member")),
        F.struct(F.col("depth_path").alias("source"), F.concat(paths.padded(F.col("member"), 4), F.lit(".depth.jpg")).alias("member")))).alias("f"))
    archives.write_tars(both.select("key", "f.*"), out)
    return placed


def tensors_from_videos(
    spark: SparkSession, root: str, out: str, decode: Callable = listing.numpy_video, chunk_size: int = 2000, size: tuple[int, int] = (360, 640),
    stride: int = 1, force: bool = False, suffix: str = ".mp4", crop: tuple[int, int] | None = None, mode: str = "half",
) -> DataFrame:
    """Resized frames with their chunk, a row a frame, written as Parquet by video; finished videos are skipped.

    A chunk is a column, not a row: a chunk of 2000 frames would be beyond what a row can hold. A video is
    finished when its frames are in the table, which a job appends to only as a whole.
    """
    todo = listing.videos(listing.list_files(spark, root), suffix)
    place = spark._jvm.org.apache.hadoop.fs.Path(out)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    if there and not force:
        todo = todo.join(spark.read.parquet(out).select(F.col("vid_path").alias("path")).distinct(), "path", "left_anti")
    frames = listing.decoded_frames(todo.repartition("path"), decode, stride)
    pixels = kernels.resized_pixels(F.col("pixels"), F.col("height"), F.col("width"), F.col("channels"), size, mode, crop)
    index = F.floor(F.col("frame_idx") / stride)
    rows = frames.where("error is null").select(
        "vid_path", index.cast("long").alias("frame_idx"), F.floor(index / chunk_size).cast("long").alias("split_ind"), (index % chunk_size).cast("long").alias("idx_in_split"),
        F.lit(size[0]).alias("height"), F.lit(size[1]).alias("width"), "channels", pixels.alias("pixels"))
    rows.write.mode("overwrite" if force else "append").parquet(out)
    return spark.read.parquet(out)


def depth_images(
    spark: SparkSession, root: str, decode: Callable, model: Callable[[], models.Model], encode: Callable = encode_png, overwrite: bool = False, ending: str = ".depth.png",
) -> DataFrame:
    """A depth image beside each image of the layout ``<digits>/<folder>/<number>.jpg`` that has none: path, written, error.

    `decode` gives an image's frames by path, of which the first counts; the depth is scaled by its own range.
    """
    todo = listing.indexed_images(listing.list_files(spark, root), overwrite, None)
    loaded: list = []

    def one(path: str) -> list[tuple]:
        if not loaded:
            loaded.append(model())
        frame = next(iter(decode(path)))
        depth = loaded[0](frame.astype(np.float32).transpose(2, 0, 1)[None])[0].reshape(frame.shape[:2])
        fs, name = archives.open_store(path.removesuffix(".jpg") + ending)
        archives.store(fs, name, encode(kernels.depth_bytes(depth)[:, :, None]))
        return [(name,)]

    return materialise(listing.per_file(todo.repartition("path"), one, "written string"), "depth-images")


def depth_tensors(frames: DataFrame, chain: Callable[[], models.Model], shape: tuple[int, int, int], size: int = 500, order: tuple[str, ...] = ("vid_path", "frame_idx"), x: str = "x") -> DataFrame:
    """The depth of frames, CHW bytes in `x`, scaled by the range of their batch of `size` frames in `order`: `depth`, 0 to 255."""
    c, h, w = shape
    inferred = frames.withColumn("_d", models.batched(chain, shape, h * w, size)(F.transform(x, lambda v: (v / F.lit(255.0)).cast("float"))))
    numbered = sharding.with_position(inferred, *order)
    return batches.batch_to_bytes(numbered, "_d", size, name="depth").drop("_d", "pos", "batch_id")


def depth_latents(rgb: DataFrame, depth: DataFrame, encoder: Callable[[], models.Model], shape: tuple[int, int, int], values: int, size: int = 128, done: DataFrame | None = None) -> DataFrame:
    """Latents of frames with their depth, by (vid_path, frame_idx): both to -1..1 and bfloat16, channels together, encoded.

    `rgb` has x and `depth` has depth, bytes, CHW. Frames of `done` are left out.
    """
    both = rgb.join(depth.select("vid_path", "frame_idx", "depth"), ["vid_path", "frame_idx"])
    both = both if done is None else pairing.todo(both, done, ["vid_path", "frame_idx"])
    encode = models.batched(encoder, shape, values, size)
    x = F.transform(batches.preprocess(F.col("x"), F.col("depth")), lambda v: v.cast("float"))
    return both.select("vid_path", "frame_idx", encode(x).alias("latent"))


def _frames(spark: SparkSession, tensors: str) -> tuple[DataFrame, tuple[int, int, int]]:
    """The frames of a table that `tensors_from_videos` wrote, flat and CHW in `x`, and their shape."""
    rows = spark.read.parquet(tensors)
    first = rows.select("height", "width", "channels").first()
    if first is None:
        raise ValueError(f"no frames in {tensors}")
    h, w, c = first
    rows = rows.withColumn("bytes", kernels.bytes_to_array(F.col("pixels")))
    return rows.select("vid_path", "frame_idx", tensor.hwc_to_chw(F.col("bytes"), h, w, c).alias("x")), (c, h, w)


def _unfinished(spark: SparkSession, frames: DataFrame, out: str, force: bool) -> DataFrame:
    """Frames of videos that `out` doesn't have; it is appended to by whole videos only."""
    place = spark._jvm.org.apache.hadoop.fs.Path(out)
    if force or not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return frames
    return pairing.todo(frames, spark.read.parquet(out).select("vid_path").distinct(), ["vid_path"])


def depth_from_tensors(
    spark: SparkSession, tensors: str, out: str, model: Callable[[], models.Model], inside: tuple[int, int] = (518, 518), batch_size: int = 500, force: bool = False,
) -> DataFrame:
    """The depth of every frame of a table of tensors, as Parquet by (vid_path, frame_idx); finished videos are skipped."""
    frames, shape = _frames(spark, tensors)
    depth = depth_tensors(_unfinished(spark, frames, out, force), models.depth_chain(model, inside), shape, batch_size)
    depth.select("vid_path", "frame_idx", "depth").write.mode("overwrite" if force else "append").parquet(out)
    return spark.read.parquet(out)


def depthlatents_from_tensors(
    spark: SparkSession, tensors: str, depths: str, out: str, encoder: Callable[[], models.Model], values: int, batch_size: int = 128, force: bool = False,
) -> DataFrame:
    """Latents of the frames that have depth, as Parquet by (vid_path, frame_idx); finished videos are skipped."""
    frames, (c, h, w) = _frames(spark, tensors)
    found = depth_latents(_unfinished(spark, frames, out, force), spark.read.parquet(depths), encoder, (c + 1, h, w), values, batch_size)
    found.write.mode("overwrite" if force else "append").parquet(out)
    return spark.read.parquet(out)


def named(name: str) -> Callable:
    """What ``package.module:name`` names, such as the loader of a model."""
    module, _, item = name.partition(":")
    return getattr(importlib.import_module(module), item)


def stream_windows(
    spark: SparkSession, root: str, out: str, state: str, decode: Callable = listing.numpy_video, n_frames: int = 16, stride: int = 1, fps: int = 30,
    resize_to: tuple[int, int] | None = (256, 256), suffix: str = ".mp4", queue: int = 64,
) -> list[dict]:
    """The producer: windows of all videos that arrive below `root`, published to `out`; `queue` bounds the files of a batch."""
    files = stream.stream_files(spark, root, f"*{suffix}", queue)
    return stream.publish(stream.produce_windows(files, decode, n_frames, stride, fps, resize_to), out, state)


def video_latents(spark: SparkSession, published: str, out: str, state: str, encoder: Callable[[], models.Model], shape: tuple[int, int, int], values: int, size: int = 32) -> list[dict]:
    """The consumer: a latent a frame of published windows, keyed by video, window and frame, to `out`; returns its progress."""
    c, h, w = shape
    encode = models.batched(encoder, shape, values, size)
    windows = stream.read_stream(spark, published).where("error is null").select(batches.payload(F.col("frames"), "vid_path", "idx_in_vid", "shape").alias("payload"))
    frames = batches.unpack(windows).select("vid_path", "idx_in_vid", F.posexplode(_cut_frames(h * w * c)(F.col("frames"))).alias("frame", "pixels"))
    frames = frames.withColumn("bytes", kernels.bytes_to_array(F.col("pixels")))
    x = F.transform(tensor.to_unit_range(tensor.hwc_to_chw(F.col("bytes"), h, w, c), "bfloat16"), lambda v: v.cast("float"))
    return stream.publish(frames.select("vid_path", "idx_in_vid", "frame", encode(x).alias("latent")), out, state)


def _cut_frames(size: int):
    @F.arrow_udf("array<binary>")
    def cut(data: pa.Array) -> pa.Array:
        whole = [d.as_py() for d in data]
        return pa.array([[d[i : i + size] for i in range(0, len(d), size)] for d in whole], pa.list_(pa.binary()))

    return cut


def dashcam_chunks(
    spark: SparkSession, root: str, out: str, decode: Callable = listing.numpy_video, chunk_size: int = 512, size: tuple[int, int] = (360, 640), leaf: str = "video.hevc",
) -> DataFrame:
    """Frames of dashcam segments, cut to 16 by 9, resized and numbered by chunks, as Parquet by chunk, drive and segment; replaced whole."""
    segments = listing.dashcam_segments(listing.list_files(spark, root), leaf)
    frames = listing.decoded_frames(segments.repartition("path"), decode).where("error is null")
    pixels = kernels.resized_pixels(F.col("pixels"), F.col("height"), F.col("width"), F.col("channels"), size, "antialias", (16, 9))
    rows = frames.join(segments.withColumnRenamed("path", "vid_path"), "vid_path").select(
        "chunk", "drive", "segment", F.floor(F.col("frame_idx") / chunk_size).cast("long").alias("i"), (F.col("frame_idx") % chunk_size).alias("idx_in_chunk"),
        F.lit(size[0]).alias("height"), F.lit(size[1]).alias("width"), "channels", pixels.alias("pixels"))
    rows.write.mode("overwrite").partitionBy("chunk", "drive", "segment").parquet(out)
    return spark.read.option("recursiveFileLookup", "false").schema(rows.schema).parquet(out)


def count_images(spark: SparkSession, root: str, include_depth: bool = True) -> int:
    return monitor.count_images(listing.list_files(spark, root), include_depth=include_depth).first().n_images


def watch_images(spark: SparkSession, root: str, polls: int = 0, interval: float = 5.0, include_depth: bool = True) -> Iterator[tuple[int, int, float]]:
    """(images, more than before, those a second) at each poll; `polls` 0 goes on for ever."""
    before, began, poll = None, time.monotonic(), 0
    while not polls or poll < polls:
        if poll:
            time.sleep(interval)
        n, now = count_images(spark, root, include_depth), time.monotonic()
        delta, passed = n - (n if before is None else before), now - began
        yield n, delta, delta / passed if passed > 0 else 0.0
        before, began, poll = n, now, poll + 1


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="framewright")
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("frames-to-images")
    job.add_argument("root")
    job.add_argument("out")
    job.add_argument("--frame-skip", type=int, default=30)
    job.add_argument("--workers", type=int, default=8)
    job.add_argument("--suffix", default="mp4")
    job.add_argument("--images-per-subdir", type=int, default=1000)
    job = jobs.add_parser("shuffled-tars")
    job.add_argument("root")
    job.add_argument("out")
    job.add_argument("--images-per-tar", type=int, default=1000)
    job.add_argument("--tars-per-subdir", type=int, default=100)
    job.add_argument("--ranks", type=int, default=8)
    job.add_argument("--seed", type=int, default=42)
    job = jobs.add_parser("tensors-from-videos")
    job.add_argument("root")
    job.add_argument("out")
    job.add_argument("--chunk-size", type=int, default=2000)
    job.add_argument("--size", type=int, nargs=2, default=(360, 640))
    job.add_argument("--stride", type=int, default=1)
    job.add_argument("--force", action="store_true")
    job = jobs.add_parser("stream-windows")
    job.add_argument("root")
    job.add_argument("out")
    job.add_argument("state")
    job.add_argument("--n-frames", type=int, default=16)
    job.add_argument("--stride", type=int, default=1)
    job.add_argument("--fps", type=int, default=30)
    job.add_argument("--resize-to", type=int, nargs="+", default=(256,))
    job.add_argument("--suffix", default=".mp4")
    job.add_argument("--queue", type=int, default=64)
    job = jobs.add_parser("depth-images")
    job.add_argument("root")
    job.add_argument("--decode", type=named, default=listing.numpy_video)
    job.add_argument("--model", type=named, required=True)
    job.add_argument("--overwrite", action="store_true")
    job = jobs.add_parser("depth-from-tensors")
    job.add_argument("root")
    job.add_argument("out")
    job.add_argument("--model", type=named, required=True)
    job.add_argument("--inside", type=int, nargs=2, default=(518, 518))
    job.add_argument("--batch-size", type=int, default=500)
    job.add_argument("--force", action="store_true")
    job = jobs.add_parser("depthlatents-from-tensors")
    job.add_argument("root")
    job.add_argument("depths")
    job.add_argument("out")
    job.add_argument("--encoder", type=named, required=True)
    job.add_argument("--values", type=int, required=True)
    job.add_argument("--batch-size", type=int, default=128)
    job.add_argument("--force", action="store_true")
    job = jobs.add_parser("video-latents")
    job.add_argument("root")
    job.add_argument("out")
    job.add_argument("state")
    job.add_argument("--encoder", type=named, required=True)
    job.add_argument("--shape", type=int, nargs=3, default=(3, 256, 256))
    job.add_argument("--values", type=int, required=True)
    job.add_argument("--size", type=int, default=32)
    job = jobs.add_parser("dashcam-chunks")
    job.add_argument("root")
    job.add_argument("out")
    job.add_argument("--chunk-size", type=int, default=512)
    job.add_argument("--size", type=int, nargs=2, default=(360, 640))
    job = jobs.add_parser("watch-images")
    job.add_argument("root")
    job.add_argument("--polls", type=int, default=0)
    job.add_argument("--interval", type=float, default=5.0)
    job = jobs.add_parser("count-images")
    job.add_argument("root")
    job.add_argument("--without-depth", action="store_true")
    given = vars(parser.parse_args(args))
    spark = SparkSession.builder.appName("framewright").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    settings.apply_credentials(spark, ".env")
    name, root = given.pop("job"), given.pop("root")
    if name == "count-images":
        print(count_images(spark, root, not given["without_depth"]))
    elif name == "frames-to-images":
        print(frames_to_images(spark, root, **given))
    elif name == "shuffled-tars":
        shuffled_tars(spark, root, **given).groupBy("key").count().show(truncate=False)
    elif name == "watch-images":
        for n, more, speed in watch_images(spark, root, **given):
            print(f"{n} images, {more} more, {speed:.1f} a second")
    elif name == "stream-windows":
        given["resize_to"] = tuple(given["resize_to"]) * (3 - len(given["resize_to"]))
        for progress in stream_windows(spark, root, **given):
            print(progress)
    elif name == "video-latents":
        given["shape"] = tuple(given["shape"])
        for progress in video_latents(spark, root, **given):
            print(progress)
    elif name == "depth-images":
        depth_images(spark, root, **given).groupBy("error").count().show(truncate=False)
    elif name == "depth-from-tensors":
        given["inside"] = tuple(given["inside"])
        print(depth_from_tensors(spark, root, **given).count())
    elif name == "depthlatents-from-tensors":
        print(depthlatents_from_tensors(spark, root, **given).count())
    else:
        given["size"] = tuple(given["size"])
        print((dashcam_chunks if name == "dashcam-chunks" else tensors_from_videos)(spark, root, **given).count())


if __name__ == "__main__":
    main()
