"""Registered queries over files: trees written from the fixture tables, then listed, decoded and processed.

A conversation stands for a video, with a frame of 4 by 4 RGB pixels a turn; its file holds an array of frames.
"""

from __future__ import annotations

import io
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .functions import codecs, kernels, models, paths
from .operators import batches, monitor
from .plans import jobs
from .queries import pixels, quantised, query, table, vectors
from .sources import archives, listing
from .storage import scratch
from .streaming import windows as stream


def tree(files: DataFrame, *names: str) -> str:
    """Write (name, content) below a fresh folder; returns it."""
    root = scratch(files.sparkSession, "tree")
    archives.write_files(files.select("name", "content"), root)
    return root


def below(path: Column, root: str) -> Column:
    """The part of a path below `root`."""
    return F.substring_index(path, root.rpartition("/")[2] + "/", -1)


def pixel(video: int, frame: int) -> np.ndarray:
    return ((video * 7 + frame * 13 + np.arange(48) * 5) % 256).astype(np.uint8).reshape(4, 4, 3)


@F.arrow_udf(BinaryType())
def video_file(video: pa.Array, frames: pa.Array) -> pa.Array:
    return pa.array([codecs.encode_array(np.stack([pixel(v, i) for i in range(n)])) for v, n in zip(video.to_pylist(), frames.to_pylist(), strict=True)], pa.binary())


@F.arrow_udf(BinaryType())
def streams_file(video: pa.Array, frames: pa.Array) -> pa.Array:
    """Two streams in a file, of which the second is not to be read."""
    out = []
    for v, n in zip(video.to_pylist(), frames.to_pylist(), strict=True):
        file = io.BytesIO()
        np.savez(file, video=np.stack([pixel(v, i) for i in range(n)]), other=np.zeros((1, 1, 1, 3), np.uint8))
        out.append(file.getvalue())
    return pa.array(out, pa.binary())


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n, name and content of the videos."""
    found = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return found.select("conv_id", "n", F.concat(F.lit("v/"), paths.padded(F.col("conv_id"), 6), F.lit(".mp4")).alias("name"), video_file("conv_id", "n").alias("content"))


def videos(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root = tree(conversations(spark, sf_dir))
    return root, listing.videos(listing.list_files(spark, root))


def total(pixels: Column) -> Column:
    """The sum of the bytes of frames."""
    return F.aggregate(kernels.bytes_to_array(pixels), F.lit(0).cast("long"), lambda a, v: a + v)


def number(name: Column) -> Column:
    """The digits before the endings of a name."""
    return F.regexp_extract(name, r"([0-9]+)(\.[a-z0-9]+)*$", 1).cast("long")


def wide(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


# Listings.


def page_files(spark: SparkSession, sf_dir: str) -> str:
    """A file a page; every seventh in a hidden folder, names with a space and marks."""
    kind, i = F.element_at(F.array(F.lit(".mp4"), F.lit(".MP4"), F.lit(".txt")), (F.col("page_id") % 3 + 1).cast("int")), F.col("page_id").cast("string")
    folder = F.when(F.col("page_id") % 7 == 0, F.lit("_hidden/")).otherwise(F.lit("a b/"))
    return tree(table(spark, sf_dir, "pages").select(F.concat(folder, i, kind).alias("name"), F.encode(F.coalesce("url", F.lit("")), "UTF-8").alias("content")))


@query
def list_videos(spark, sf_dir):
    root = page_files(spark, sf_dir)
    return listing.videos(listing.list_files(spark, root)).select(below(F.col("path"), root).alias("name"), "length")


@query
def list_videos_any_case(spark, sf_dir):
    root = page_files(spark, sf_dir)
    return listing.videos(listing.list_files(spark, root), "mp4", any_case=True).select(below(F.col("path"), root).alias("name"), "length")


@query
def walk_videos(spark, sf_dir):
    """By a walk of the mounted file system, which sees hidden folders."""
    root = page_files(spark, sf_dir)
    return listing.videos(listing.walk_files(spark, root)).select(below(F.col("path"), root).alias("name"), "length")


@query
def sharded_listing(spark, sf_dir):
    root = page_files(spark, sf_dir)
    return listing.sharded_videos(spark, root, nodes=3, workers=2).select(below(F.col("path"), root).alias("name"), "node", "worker")


def labelled_files(spark: SparkSession, sf_dir: str, name: Column, *siblings: tuple[Column, Column]) -> str:
    """A file a document under `name`, and others under (name, condition)."""
    docs = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    names = F.array(name, *(F.when(condition, other) for other, condition in siblings))
    return tree(docs.select(F.explode(names).alias("name")).where("name is not null").withColumn("content", F.encode("name", "UTF-8")))


def image_name(ending: str) -> Column:
    d = F.col("doc_id")
    return F.concat((d % 3).cast("string"), F.lit("/"), paths.padded(F.floor(d / 50).cast("long"), 6), F.lit("/"), paths.padded(d % 50 * 30, 4), F.lit(ending))


@query
def indexed_listing(spark, sf_dir):
    """Images without a depth image, of numbers below 1000."""
    root = labelled_files(spark, sf_dir, image_name(".jpg"), (image_name(".depth.jpg"), F.col("quality").isNotNull()))
    return listing.indexed_images(listing.list_files(spark, root)).select("top", "subdir", "number")


def chunk_files(spark: SparkSession, sf_dir: str) -> str:
    name = lambda kind: F.concat(F.lit("splits/"), paths.padded(F.col("doc_id"), 8), F.lit(kind))
    return labelled_files(spark, sf_dir, name("_rgb.pt"), (name("_depth.pt"), F.col("quality").isNotNull()), (name("_depthlatent.pt"), F.col("quality") == 1))


@query
def tensor_listing(spark, sf_dir):
    files = listing.list_files(spark, chunk_files(spark, sf_dir))
    return listing.tensors_without(files).select(paths.basename(F.col("rgb")).alias("rgb"), paths.basename(F.col("result")).alias("result"))


@query
def latent_listing(spark, sf_dir):
    files = listing.list_files(spark, chunk_files(spark, sf_dir))
    found = listing.tensors_without(files, "_depthlatent.pt", needs="_depth.pt")
    return found.select(*(paths.basename(F.col(c)).alias(c) for c in ("rgb", "other", "result")))


@query
def pair_listing(spark, sf_dir):
    name = lambda kind: F.concat(F.lit("d/"), F.col("doc_id").cast("string"), kind)
    rgb = F.when(F.col("doc_id") % 2 == 0, F.lit(".JPG")).otherwise(F.lit(".jpg"))
    root = labelled_files(spark, sf_dir, name(rgb), (name(F.lit(".depth.jpg")), F.col("quality").isNotNull()))
    return listing.image_pairs(listing.list_files(spark, root)).select(*(paths.basename(F.col(c)).alias(c) for c in ("rgb_path", "depth_path")))


def segment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    name = F.concat(F.lit("Chunk_"), (c % 3).cast("string"), F.lit("/d"), (c % 4).cast("string"), F.lit("/"), c.cast("string"), F.lit("/"),
                    F.when(c % 6 == 5, F.lit("other.bin")).otherwise(F.lit("video.hevc")))
    return conversations(spark, sf_dir).withColumn("name", name)


@query
def dashcam_listing(spark, sf_dir):
    return listing.dashcam_segments(listing.list_files(spark, tree(segment_files(spark, sf_dir)))).select("chunk", "drive", "segment")


@query
def zip_members(spark, sf_dir):
    """Members of all but one of the archives."""

    @F.arrow_udf("binary")
    def packed(names: pa.Array) -> pa.Array:
        out = []
        for members in names.to_pylist():
            file = io.BytesIO()
            with zipfile.ZipFile(file, "w") as z:
                for m in sorted(members):
                    z.writestr(f"d/{m}.txt", f"content {m}")
            out.append(file.getvalue())
        return pa.array(out, pa.binary())

    groups = conversations(spark, sf_dir).groupBy((F.col("conv_id") % 3).alias("g")).agg(F.collect_list(F.col("conv_id").cast("string")).alias("ids"))
    root = tree(groups.select(F.concat(F.lit("Chunk_"), F.col("g").cast("string"), F.lit(".zip")).alias("name"), packed("ids").alias("content")))
    found = listing.unzip_members(spark, root, ["Chunk_2.zip"])
    return found.select(paths.basename(F.col("archive")).alias("archive"), "member", F.decode("content", "UTF-8").alias("content"))


# Decoders and readers.


@query
def decode_listing(spark, sf_dir):
    """Every second frame of every video; a file that is none gives a row that says so."""
    made = conversations(spark, sf_dir).withColumn("content", F.when(F.col("conv_id") % 5 == 0, F.encode(F.lit("no video"), "UTF-8")).otherwise(F.col("content")))
    found = listing.decoded_frames(listing.videos(listing.list_files(spark, tree(made))), listing.numpy_video, 2)
    return found.select(number(F.col("vid_path")).alias("conv_id"), "frame_idx", *wide("height", "width", "channels"), total(F.col("pixels")).alias("total"), F.col("error").isNotNull().alias("failed"))


@query
def first_stream(spark, sf_dir):
    root = tree(conversations(spark, sf_dir).withColumn("content", streams_file("conv_id", "n")))
    found = listing.decoded_frames(listing.videos(listing.list_files(spark, root)), listing.numpy_video)
    return found.groupBy(number(F.col("vid_path")).alias("conv_id")).agg(F.count("*").alias("n_frames"), F.sum(total(F.col("pixels"))).alias("total"))


@F.arrow_udf(BinaryType())
def image_file(values: pa.Array, good: pa.Array) -> pa.Array:
    frames = [np.array(v, np.uint8).reshape(4, 4, 3) for v in values.to_pylist()]
    return pa.array([codecs.encode_png(f) if g else b"no image" for f, g in zip(frames, good.to_pylist(), strict=True)], pa.binary())


@query
def image_read(spark, sf_dir):
    """PNG files through Spark's reader, unreadable ones as such; blue is the first byte of its pixels."""
    rows = quantised(vectors(spark, sf_dir)).select(
        F.concat(F.lit("i/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("name"), image_file(F.slice("q", 1, 48), F.col("vec_id") % 9 > 0).alias("content"))
    found = listing.read_images(spark, tree(rows), rejects=True)
    return found.select(
        number(F.col("origin")).alias("vec_id"), *wide("height", "width", "channels"), total(F.col("pixels")).alias("total"),
        F.get(kernels.bytes_to_array(F.col("pixels")), F.lit(0)).cast("long").alias("blue"), "error")


@query
def array_read(spark, sf_dir):
    @F.arrow_udf("binary")
    def file(values: pa.Array) -> pa.Array:
        return pa.array([codecs.encode_array(np.array(v).reshape(4, 16)) for v in values.to_pylist()], pa.binary())

    root = tree(vectors(spark, sf_dir).select(F.concat(F.col("vec_id").cast("string"), F.lit(".npy")).alias("name"), file("x").alias("content")))
    found = listing.read_arrays(spark, root)
    return found.select(
        number(paths.basename(F.col("path"))).alias("vec_id"), F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), "dtype",
        F.get("values", F.lit(0)).alias("first"), F.get("values", F.lit(63)).alias("last"))


@query
def file_task(spark, sf_dir):
    """Any function a file: here the number of its bytes; it fails for some, which are rows too."""

    def task(path: str) -> list[tuple]:
        data = archives.read_file(path)
        if len(data) % 5 == 0:
            raise ValueError("five")
        return [(len(data), data[:4].decode())]

    root = page_files(spark, sf_dir)
    found = listing.per_file(listing.list_files(spark, root), task, "n long, head string")
    return found.select(below(F.col("path"), root).alias("name"), "n", "head", "error")


@query
def tar_members(spark, sf_dir):
    """Documents to archives of seven members, and read back."""
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        F.concat(paths.padded(F.floor(d / 7).cast("long"), 4), F.lit(".tar")).alias("key"), F.concat(paths.padded(d % 7, 4), F.lit(".txt")).alias("member"),
        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    root = scratch(spark, "tars")
    archives.write_tars(rows, root)
    found = archives.read_tars(spark, root)
    return found.select(below(F.col("archive"), root).alias("archive"), "member", F.sha2("content", 256).alias("sha256"))


@query
def tar_job(spark, sf_dir):
    """Pairs of files to shuffled archives, and read back: what lies where."""
    root = labelled_files(spark, sf_dir, image_name(".jpg"), (image_name(".depth.jpg"), F.col("quality").isNotNull()))
    out = scratch(spark, "tar-job")
    jobs.shuffled_tars(spark, root, out, images_per_tar=5, tars_per_subdir=3, ranks=2)
    found = archives.read_tars(spark, out)
    split = F.element_at(F.split("member", r"\.", 2), 2)
    kinds = found.groupBy(below(F.col("archive"), out).alias("archive")).agg(F.count_if(split == "jpg").alias("n_rgb"), F.count_if(split == "depth.jpg").alias("n_depth"))
    return kinds


# Jobs.


def names_below(spark: SparkSession, out: str) -> DataFrame:
    return listing.list_files(spark, out).select(below(F.col("path"), out).alias("name"))


@query
def image_tree(spark, sf_dir):
    """Every second frame as an image; numbers run over a worker's videos."""
    root, out = tree(conversations(spark, sf_dir)), scratch(spark, "images")
    jobs.frames_to_images(spark, root, out, frame_skip=1, workers=3, images_per_subdir=5)
    return names_below(spark, out)


@query
def image_tree_by_video(spark, sf_dir):
    root, out = tree(conversations(spark, sf_dir)), scratch(spark, "images")
    jobs.frames_to_images(spark, root, out, frame_skip=1, workers=3, images_per_subdir=2, layout="video")
    return names_below(spark, out)


@query
def image_tree_flat(spark, sf_dir):
    root, out = tree(conversations(spark, sf_dir)), scratch(spark, "images")
    jobs.frames_to_images(spark, root, out, frame_skip=1, workers=3, layout="flat")
    return names_below(spark, out)


@query
def tensor_chunks(spark, sf_dir):
    root = tree(conversations(spark, sf_dir))
    found = jobs.tensors_from_videos(spark, root, scratch(spark, "tensors"), chunk_size=3, size=(4, 4))
    return found.select(number(F.col("vid_path")).alias("conv_id"), "split_ind", "idx_in_split", total(F.col("pixels")).alias("total"))


@query
def dashcam_chunks(spark, sf_dir):
    found = jobs.dashcam_chunks(spark, tree(segment_files(spark, sf_dir)), scratch(spark, "dashcam"), chunk_size=3, size=(2, 3))
    return found.groupBy("chunk", "drive", F.col("segment").cast("string").alias("segment"), "i").agg(F.count("*").alias("n_frames"), F.sum(F.length("pixels")).cast("long").alias("bytes"))


@query
def depth_image_job(spark, sf_dir):
    """Depth images beside images, by the stand-in model one image at a time; read back as images."""
    c = F.col("conv_id")
    name = lambda kind: F.concat((c % 2).cast("string"), F.lit("/000000/"), paths.padded(c, 4), F.lit(kind))
    root = tree(conversations(spark, sf_dir).withColumn("name", name(".jpg")))
    done = jobs.depth_images(spark, root, listing.numpy_video, models.mean_depth())
    found = listing.read_images(spark, root, rejects=True).where(F.col("origin").endswith(".depth.png"))
    found = found.select(number(F.col("origin")).alias("conv_id"), *wide("height", "width", "channels"), total(F.col("pixels")).alias("total"))
    return found.join(done.where("error is null").select(number(F.col("written")).alias("conv_id")), "conv_id", "left_semi")


@query
def depth_tensor_job(spark, sf_dir):
    """The whole chain over batches of 32 frames: standardise, resize, model, resize back, range of the batch."""
    frames = quantised(vectors(spark, sf_dir)).select(F.lit("v").alias("vid_path"), F.col("vec_id").alias("frame_idx"), F.slice("q", 1, 48).alias("x"))
    depth = jobs.depth_tensors(frames, models.depth_chain(models.mean_depth(), (7, 7)), (3, 4, 4), 32)
    return pixels(depth.withColumnRenamed("frame_idx", "vec_id"), "depth")


@query
def depth_latent_job(spark, sf_dir):
    """Latents of frames with their depth; every fifth frame is done already."""
    frames = quantised(vectors(spark, sf_dir)).select(F.lit("v").alias("vid_path"), F.col("vec_id").alias("frame_idx"), F.slice("q", 1, 48).alias("x"), F.slice("q", 49, 16).alias("depth"))
    got = jobs.depth_latents(frames.drop("depth"), frames.drop("x"), models.block_means(2), (4, 4, 4), 4, 32, frames.where("frame_idx % 5 = 0"))
    return pixels(got.withColumnRenamed("frame_idx", "vec_id"), "latent", 4)


def published(spark: SparkSession, sf_dir: str) -> str:
    out = scratch(spark, "published")
    jobs.stream_windows(spark, tree(conversations(spark, sf_dir)), out, f"{out}-state", n_frames=2, resize_to=(4, 4))
    return out


@query
def window_stream(spark, sf_dir):
    """What the producer publishes: windows of two frames with their metadata."""
    found = spark.read.option("recursiveFileLookup", "true").parquet(published(spark, sf_dir)).where("error is null")
    return found.select(
        number(F.col("vid_name")).alias("conv_id"), "vid_name", "idx_in_vid", "start_frame", "end_frame", "start_ts", "end_ts",
        F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), total(F.col("frames")).alias("total"))


@query
def latent_stream(spark, sf_dir):
    """What the consumer stores: a latent a frame, keyed by video, window and frame."""
    files, out = published(spark, sf_dir), scratch(spark, "latents")
    root = scratch(spark, "flat")
    spark.read.option("recursiveFileLookup", "true").parquet(files).write.parquet(root)
    jobs.video_latents(spark, root, out, f"{out}-state", models.block_means(2), (3, 4, 4), 4, 8)
    found = spark.read.option("recursiveFileLookup", "true").parquet(out)
    return pixels(found.withColumn("conv_id", number(F.col("vid_path"))).withColumn("frame", F.col("frame").cast("long")), "latent", 4, ("conv_id", "idx_in_vid", "frame"))


@query
def weights_model(spark, sf_dir):
    """A model whose weights are shipped to every executor as a file."""
    root = scratch(spark, "weights")
    matrix = np.add.outer(np.arange(64) % 3, np.arange(2)).astype(np.float64)
    fs, name = archives.open_store(f"{root}/weights.npy")
    archives.store(fs, name, codecs.encode_array(matrix))
    run = models.batched(models.linear(models.weights(spark, f"{root}/weights.npy")), (1, 8, 8), 2, 32)
    return pixels(quantised(vectors(spark, sf_dir)).select("vec_id", run(F.col("q").cast("array<float>")).alias("t")), "t", 2)


@query
def resource_task(spark, sf_dir):
    """A batch function with the accelerators that the master has; on a local one with none."""

    def run(parts):
        for batch in parts:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64())], ["vec_id", "n"])

    return vectors(spark, sf_dir).select("vec_id", "x").mapInArrow(run, "vec_id long, n long", profile=models.on_accelerators(spark))


@query
def image_watch(spark, sf_dir):
    """Two polls of a monitor, with more images between them."""
    even = table(spark, sf_dir, "documents").select("doc_id", image_name(".jpg").alias("name"), F.encode(F.lit("x"), "UTF-8").alias("content"))
    root = tree(even.where("doc_id % 2 = 0"))
    polls = jobs.watch_images(spark, root, polls=2, interval=0.0)
    told = [next(polls)]
    archives.write_files(even.where("doc_id % 2 = 1").select("name", "content"), root)
    told.append(next(polls))
    return spark.createDataFrame([(i, n, more) for i, (n, more, _) in enumerate(told)], "poll long, n_images long, more long")


@query
def stream_shuffle(spark, sf_dir):
    return stream.run_shuffle_buffer(spark, f"{sf_dir}/events.parquet", 8, 42)


@query
def stream_progress(spark, sf_dir):
    return stream.run_progress(spark, f"{sf_dir}/events.parquet").groupBy().agg(F.sum("rows").alias("rows"))


@query
def payload_projection(spark, sf_dir):
    sent = vectors(spark, sf_dir).select(batches.payload(F.col("x"), "vec_id", "label").alias("payload"))
    return batches.unpack(sent).select("vec_id", "label", F.size("frames").cast("long").alias("n"), F.get("frames", F.lit(0)).alias("first"))


@query
def average_fps(spark, sf_dir):
    events = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    return events.select("user_id", F.round(monitor.average_fps(F.col("n"), F.col("a"), F.col("b")), 9).alias("fps"))
