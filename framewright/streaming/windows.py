"""Count windows, running counts and model sinks on streams."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import models
from ..functions.kernels import resize
from ..storage import scratch


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 64, bytes_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they arrive; the bound on files, or on bytes, a trigger is the queue's high-water mark."""
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    bound = ("maxBytesPerTrigger", bytes_per_trigger) if bytes_per_trigger else ("maxFilesPerTrigger", files_per_trigger)
    stream = stream.option(*bound)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():  # streams watch folders
        stream, path = stream.option("pathGlobFilter", place.getName()), str(place.getParent())
    return stream.parquet(path)


def count_windows(frames: DataFrame, video: str, order: list[str], value: str, size: int) -> DataFrame:
    """Whole windows of `size` frames of each video; what is left over waits in state for the next batch.

    State is the number of the next window and the values of the frames that wait, fewer than `size`. Frames
    are sorted within a batch; batches have to arrive in order. A tail is never emitted, as no end is known.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, waiting = state.get if state.exists else (0, [])
        rows = pd.concat(list(parts)).sort_values(order, kind="stable")
        waiting = list(waiting) + rows[value].tolist()
        whole = len(waiting) // size
        found = [(key[0], number + w, waiting[w * size], waiting[w * size + size - 1], size) for w in range(whole)]
        state.update((number + whole, [int(x) for x in waiting[whole * size :]]))
        yield pd.DataFrame(found, columns=[video, "idx_in_vid", "first_event", "last_event", "n_frames"])

    return frames.groupBy(video).applyInPandasWithState(
        step, f"{video} long, idx_in_vid long, first_event long, last_event long, n_frames long",
        "number long, waiting array<long>", "append", GroupStateTimeout.NoTimeout)


def shuffle_buffer(frames: DataFrame, consumer: str, order: list[str], value: str, size: int, seed: int) -> DataFrame:
    """The order in which a consumer's shuffle buffer gives its items out: filled, shuffled by the seed, emptied.

    What waits in state is less than a buffer. A buffer that isn't full yet gives nothing.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, waiting = state.get if state.exists else (0, [])
        rows = pd.concat(list(parts)).sort_values(order, kind="stable")
        waiting = list(waiting) + rows[value].tolist()
        whole = len(waiting) // size
        found = []
        for w in range(whole):
            items = sorted(waiting[w * size : w * size + size], key=lambda x: (hashlib.md5(f"{seed}:{x}".encode()).hexdigest(), x))
            found += [(key[0], (number + w) * size + i, item) for i, item in enumerate(items)]
        state.update((number + whole, [int(x) for x in waiting[whole * size :]]))
        yield pd.DataFrame(found, columns=[consumer, "pos", value])

    return frames.groupBy(consumer).applyInPandasWithState(
        step, f"{consumer} long, pos long, {value} long", "number long, waiting array<long>", "append", GroupStateTimeout.NoTimeout)


def produce_windows(paths: DataFrame, decode: Callable, size: int, stride: int, fps: int, to: tuple[int, int] | None = None, mode: str = "fixed") -> DataFrame:
    """Decode, keep every `stride`-th frame, resize, and cut whole windows: a row a window, with frames and metadata.

    `paths` may be a stream or a table. A video is decoded where its row is and its frames leave a window at a time,
    so no more than a window is held. A video that fails ends there; a row with `error` says so.
    """
    schema = pa.schema([
        ("vid_path", pa.string()), ("vid_name", pa.string()), ("vid_dir", pa.string()), ("idx_in_vid", pa.int64()), ("start_frame", pa.int64()), ("end_frame", pa.int64()),
        ("start_ts", pa.float64()), ("end_ts", pa.float64()), ("shape", pa.list_(pa.int32())), ("frames", pa.binary()), ("error", pa.string())])
    if stride < 1 or fps // stride < 1:
        raise ValueError("the stride leaves less than one frame a second")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(path: str, **values) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"vid_path": path, "vid_name": path.rpartition("/")[2], "vid_dir": path.rpartition("/")[0], **values}], schema=schema)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, number = [], 0
                try:
                    for i, frame in enumerate(decode(path)):
                        if i % stride:
                            continue
                        held.append(resize(frame, *to, mode) if to else frame)
                        if len(held) == size:
                            start, end = i - size * stride, i
                            yield row(path, idx_in_vid=number, start_frame=start, end_frame=end, start_ts=start / (fps // stride), end_ts=end / (fps // stride),
                                      shape=[size, *held[0].shape], frames=np.stack(held).tobytes())
                            held, number = [], number + 1
                except Exception as error:  # a bad video is data here
                    yield row(path, error=f"{type(error).__name__}: {error}"[:500])

    kind = "vid_path string, vid_name string, vid_dir string, idx_in_vid long, start_frame long, end_frame long, start_ts double, end_ts double, shape array<int>, frames binary, error string"
    return paths.select("path").mapInArrow(run, kind)


def stream_files(spark: SparkSession, root: str, pattern: str = "*", files_per_trigger: int = 64) -> DataFrame:
    """The paths of files as they arrive below `root`; their contents are not read."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = files.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger)
    return files.load(root).select("path")


def publish(stream: DataFrame, out: str, state: str, mode: str = "append") -> list[dict]:
    """Run a stream over all that is there, into Parquet files with exactly-once commits; returns the progress of each batch.

    Batches are overwritten whole when they run again after a failure, so consumers see each row once.
    """

    def sink(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{out}/batch={number:08d}")

    job = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).start()
    job.awaitTermination()
    return [{"batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond} for p in job.recentProgress]


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there, and read what its sink holds."""
    spark = stream.sparkSession
    out = scratch(spark, name)
    publish(stream, out, scratch(spark, f"{name}-state"), mode)
    return spark.read.schema(stream.schema.add("_batch", "long")).option("recursiveFileLookup", "true").parquet(out)


def run_count_windows(spark: SparkSession, path: str, size: int) -> DataFrame:
    frames = read_stream(spark, path).select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
    return run_to_end(count_windows(frames, "user_id", ["ts", "event_id"], "event_id", size), "windows").drop("_batch")


def run_counts(spark: SparkSession, path: str) -> DataFrame:
    """The polling monitor: each batch holds the counts so far; the last one stays."""
    counts = read_stream(spark, path).groupBy("event_type").agg(F.count("*").alias("n"))
    kept = run_to_end(counts, "counts", "complete")
    return kept.groupBy("event_type").agg(F.max("n").alias("n"))


def run_encoder(spark: SparkSession, path: str) -> DataFrame:
    """The consumer: encode what arrives, store it."""
    encode = models.batched(models.block_means(2), (1, 8, 8), 4, 32)
    latents = read_stream(spark, path).select("vec_id", encode(F.col("embedding").cast("array<float>")).alias("t"))
    rows = run_to_end(latents, "latents").select("vec_id", F.posexplode("t").alias("p", "v"))
    return rows.select("vec_id", F.col("p").cast("long").alias("p"), (F.round(F.col("v").cast("double"), 4) + 0.0).alias("v"))


def run_shuffle_buffer(spark: SparkSession, path: str, size: int, seed: int) -> DataFrame:
    frames = read_stream(spark, path, bytes_per_trigger=64 << 20).select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
    return run_to_end(shuffle_buffer(frames, "user_id", ["ts", "event_id"], "event_id", size, seed), "shuffled").drop("_batch")


def run_progress(spark: SparkSession, path: str) -> DataFrame:
    """What a stream's batches report: their number and the rows they read."""
    out = scratch(spark, "progress")
    told = publish(read_stream(spark, path, files_per_trigger=1).select("event_id"), out, f"{out}-state")
    return spark.createDataFrame([(p["batch"], p["rows"]) for p in told if p["rows"]], "batch long, rows long")
