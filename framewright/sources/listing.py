"""File listings as tables of paths."""

from __future__ import annotations

import io
import os
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.codecs import decode_array
from ..functions.paths import basename, depth_image_path, dirname, has_suffix, is_depth_image, strip_extension, swap_suffix
from ..operators.pairing import paired, todo, with_sibling
from ..operators.sharding import two_levels, with_position
from ..storage import materialise
from .archives import open_store, read_file


#: What is found in a folder leaves the task that lists it in batches of so many.
ENTRIES = 10_000


def _hidden(name: str) -> bool:
    """Whether Spark's readers leave a file or folder out."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(folder: str) -> Iterator[tuple[str, int | None]]:
    """Path and length of what lies in a folder; folders have no length. Links are followed, broken ones left out."""
    fs, place = open_store(folder)
    prefix = folder.rstrip("/") + "/"
    try:
        if isinstance(fs, pafs.LocalFileSystem):
            with os.scandir(place) as found:
                for e in found:
                    if not _hidden(e.name) and (e.is_dir() or os.path.exists(e.path)):
                        yield prefix + e.name, None if e.is_dir() else e.stat().st_size
        else:
            for info in fs.get_file_info(pafs.FileSelector(place)):
                if not _hidden(info.base_name):
                    yield prefix + info.base_name, None if info.type == pafs.FileType.Directory else info.size
    except FileNotFoundError:  # it went meanwhile
        return


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            found = _entries(folder)
            while rows := list(islice(found, ENTRIES)):
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["path", "length"])


def _walkable(spark: SparkSession, root: str) -> str | None:
    """The full name of a folder that tasks can list themselves; None for patterns, files and stores that only Spark reads."""
    if any(c in root for c in "{}[]*?\\"):
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    try:
        fs, name = open_store(full)
        return full if fs.get_file_info(name).type == pafs.FileType.Directory else None
    except (OSError, ValueError, NotImplementedError):  # pyarrow does not know the store
        return None


def list_files(spark: SparkSession, *roots: str) -> DataFrame:
    """path and length of every file below the roots, in any store that Spark reads; listed now, contents are not read.

    Names and folders that begin with ``_`` or ``.`` are left out, links are followed and roots that overlap
    give their files twice, as with Spark's readers. These would hold every file on the driver and
    plan a task for each few, so folders are listed by tasks, level by level, into the shared folder. Roots
    that are patterns, files or in a store that pyarrow can't open are listed by Spark, on the driver;
    that leaves out empty files.
    """
    tops, out = [], None
    for root in roots:
        if full := _walkable(spark, root):
            tops.append((full,))
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
        out = files if out is None else out.unionByName(files)
    folders, n = spark.createDataFrame(tops, "path string"), len(tops)
    while n:
        parts = min(n, spark.sparkContext.defaultParallelism * 4)
        level = materialise(folders.repartition(parts, "path").mapInArrow(_listed, "path string, length long"), "listing")
        files, folders = level.where("length is not null"), level.where("length is null").select("path")
        out, n = files if out is None else out.unionByName(files), folders.count()
    return out


def walk_files(spark: SparkSession, *roots: str) -> DataFrame:
    """path and length by a walk of a file system that is mounted everywhere: hidden names count, links to folders are not followed.

    The top folders are dealt to tasks, which walk them; so a large tree is not listed by the driver.
    """
    tops = []
    for root in roots:
        root = root.removeprefix("file://")
        entries = sorted(os.scandir(root), key=lambda e: e.name)
        tops += [(e.path, True) for e in entries if e.is_dir(follow_symlinks=False)]
        tops += [(e.path, False) for e in entries if not e.is_dir(follow_symlinks=True)]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, int]] = []
            for path, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names = [os.path.join(d, f) for d, _, files in os.walk(path) for f in files] if folder else [path]
                found += [(n, os.path.getsize(n)) for n in names if os.path.exists(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.int64())], ["path", "length"])

    parts = max(1, min(len(tops), spark.sparkContext.defaultParallelism * 4))
    return spark.createDataFrame(tops, "path string, folder boolean").repartition(parts).mapInArrow(walk, "path string, length long")


def videos(files: DataFrame, suffix: str = ".mp4", any_case: bool = False) -> DataFrame:
    """Videos by suffix; with `any_case` the dot may be left out of `suffix`."""
    if any_case and not suffix.startswith("."):
        suffix = "." + suffix
    return files.where(has_suffix(F.col("path"), suffix, any_case))


def indexed_images(files: DataFrame, overwrite: bool = False, most: int | None = 1000) -> DataFrame:
    """Images of the layout ``<digits>/<folder>/<number>.jpg`` that have no depth image yet, in order.

    `most` bounds the numbers; None takes all.
    """
    parts = F.regexp_extract
    pattern = r"/([0-9]+)/([^/]+)/([0-9]{4,})\.jpg$"
    found = files.where(F.col("path").rlike(pattern)).select(
        "path", parts("path", pattern, 1).cast("long").alias("top"), parts("path", pattern, 2).alias("subdir"),
        parts("path", pattern, 3).cast("long").alias("number"))
    if most is not None:
        found = found.where(F.col("number") < most)
    if not overwrite:
        done = files.where(is_depth_image(F.col("path"))).select(F.regexp_replace("path", r"\.depth\.jpg$", ".jpg").alias("path"))
        found = todo(found, done, ["path"])
    return found.orderBy("top", "subdir", "number")


def tensors_without(files: DataFrame, kind: str = "_depth.pt", needs: str | None = None, force: bool = False) -> DataFrame:
    """``*_rgb.pt`` files, with `needs` their sibling of that suffix, whose sibling `kind` isn't there."""
    rgb = files.where(has_suffix(F.col("path"), "_rgb.pt")).select(F.col("path").alias("rgb"))
    if needs:
        others = files.select(F.col("path").alias("other"))
        rgb = rgb.withColumn("other", swap_suffix(F.col("rgb"), "_rgb.pt", needs))
        rgb = with_sibling(rgb, others, ["other"])
    rgb = rgb.withColumn("result", swap_suffix(F.col("rgb"), "_rgb.pt", kind))
    return todo(rgb, files.select(F.col("path").alias("result")), ["result"], force)


def image_pairs(files: DataFrame) -> DataFrame:
    """rgb_path and depth_path of images that have a depth image."""
    images = files.where(has_suffix(F.col("path"), ".jpg", any_case=True) & ~is_depth_image(F.col("path")))
    images = images.select(F.col("path").alias("rgb_path"), depth_image_path(F.col("path")).alias("depth_path"))
    return paired(images, files.select(F.col("path").alias("depth_path")), ["depth_path"]).select("rgb_path", "depth_path")


def dashcam_segments(files: DataFrame, leaf: str = "video.hevc") -> DataFrame:
    """path, chunk, drive and segment of the layout ``Chunk_*/<drive>/<segment>/video.hevc``."""
    pattern = rf"/(Chunk_[^/]*)/([^/]+)/([^/]+)/{leaf.replace('.', '[.]')}$"
    part = F.regexp_extract
    return files.where(F.col("path").rlike(pattern)).select(
        "path", part("path", pattern, 1).alias("chunk"), part("path", pattern, 2).alias("drive"), part("path", pattern, 3).alias("segment"))


def unzip_members(spark: SparkSession, folder: str, exclude: list[str] | None = None) -> DataFrame:
    """archive, member and content of every file in ``Chunk_*.zip`` archives that are not excluded by name."""
    import zipfile

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "Chunk_*.zip").load(folder).select("path", "content")
    archives = archives.where(~basename(F.col("path")).isin(list(exclude or [])))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(data.as_py())) as z:
                    for info in z.infolist():
                        if not info.is_dir():
                            yield pa.RecordBatch.from_pylist([{"archive": path, "member": info.filename, "content": z.read(info)}])

    return archives.mapInArrow(members, "archive string, member string, content binary")


#: Frames leave the decoder in batches of so many bytes of pixels.
BATCH_BYTES = 8 << 20


def decoded_frames(videos: DataFrame, decode: Callable, stride: int = 1, path: str = "path") -> DataFrame:
    """A row a kept frame: vid_path, frame_idx, height, width, channels, pixels, error.

    `decode` takes a path and yields frames as height, width, channel byte arrays; it runs where the row is.
    A video that fails gives one row with `error` after the frames it did give; filter on it. Frames leave
    the generator in batches of BATCH_BYTES, so a video is never held whole.
    """
    if stride < 1:
        raise ValueError("stride is 1 at least")
    names = ["vid_path", "frame_idx", "height", "width", "channels", "pixels", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

        rows, held = [], 0
        schema = pa.schema([("vid_path", pa.string()), ("frame_idx", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                try:
                    for i, frame in enumerate(decode(name)):
                        if i % stride == 0:
                            rows.append((name, i, *frame.shape, frame.tobytes(), None))
                            held += len(rows[-1][5])
                        if held > BATCH_BYTES:
                            yield flush(rows)
                            rows, held = [], 0
                except Exception as error:  # a bad video is data here; the reject is kept
                    rows.append((name, None, None, None, None, None, f"{type(error).__name__}: {error}"[:500]))
        if rows:
            yield flush(rows)

    return videos.select(path).mapInArrow(
        run, "vid_path string, frame_idx long, height int, width int, channels int, pixels binary, error string")


def read_images(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """Images that Spark's own reader decodes (BGR); unreadable ones are dropped, or kept with `rejects`, without pixels."""
    images = spark.read.format("image").option("dropInvalid", str(not rejects).lower()).option("recursiveFileLookup", "true").load(path)
    height = F.col("image.height")
    good = height > 0  # the reader marks what it can't decode by -1
    return images.select(
        "image.origin", F.when(good, height).alias("height"), F.when(good, F.col("image.width")).alias("width"),
        F.when(good, F.col("image.nChannels")).alias("channels"), F.when(good, F.col("image.data")).alias("pixels"),
        F.when(~good, F.lit("unreadable")).alias("error"))


def read_arrays(spark: SparkSession, path: str, suffix: str = ".npy") -> DataFrame:
    """Tensors of array files: path, shape, dtype and the values, flat, as doubles."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = decode_array(data.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([list(x.shape)], pa.list_(pa.int32())), pa.array([str(x.dtype)]), pa.array([x.ravel().astype("f8")], pa.list_(pa.float64()))],
                    ["path", "shape", "dtype", "values"])

    return files.select("path", "content").mapInArrow(run, "path string, shape array<int>, dtype string, values array<double>")


def per_file(files: DataFrame, task: Callable, schema: str, path: str = "path") -> DataFrame:
    """Any task a file: `task` takes a path and yields rows of `schema`; one that fails gives a row with `error` instead.

    The rows have path and error besides the columns of `schema`. Files are tasks' rows, so a lost executor costs its
    files only.
    """
    wanted = files.sparkSession.createDataFrame([], f"path string, {schema}, error string").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, names = to_arrow_schema(wanted), wanted.names
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                try:
                    rows = [dict(zip(names, (name, *values, None), strict=True)) for values in task(name)]
                except Exception as error:  # a bad file is data here
                    rows = [{"path": name, "error": f"{type(error).__name__}: {error}"[:500]}]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.select(path).mapInArrow(run, wanted)


def numpy_video(path: str, stream: int = 0) -> Iterator:
    """Stand-in decoder: an array of frames under any name; of several in one ``.npz`` file, the one at `stream`."""
    data = read_file(path)
    if data[:2] == b"PK":
        with np.load(io.BytesIO(data), allow_pickle=False) as streams:
            yield from streams[streams.files[stream]]
    else:
        yield from decode_array(data)


def sharded_videos(spark: SparkSession, *roots: str, suffix: str = ".mp4", nodes: int = 1, workers: int = 1) -> DataFrame:
    """The videos of a node's workers: path, node and worker, in contiguous runs of sorted paths."""
    found = with_position(videos(list_files(spark, *roots), suffix).select("path"), "path", total="total")
    return two_levels(found, nodes, workers).select("path", "node", "worker")


def siblings(path: str = "path") -> list:
    """Folder and stem, the key that siblings share."""
    return [dirname(F.col(path)).alias("dir"), strip_extension(basename(F.col(path))).alias("stem")]
