"""Files and tar archives as Spark sinks: each written whole or not at all."""

from __future__ import annotations

import io
import re
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a name such as Spark gives, and the name within it; characters such as # and % stay as they are."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]+):(//([^/]*))?(/.*)?$", uri, re.S)
    if not found:
        return pafs.LocalFileSystem(), uri
    scheme, _, authority, path = found.groups()
    if scheme == "file":
        return pafs.LocalFileSystem(), path or "/"
    fs, root = pafs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return fs, f"{root.rstrip('/')}{path or ''}".lstrip("/") if root.strip("/") else path or "/"


def store(fs: pafs.FileSystem, name: str, content) -> None:
    """A whole file or nothing; to write the same again is harmless."""
    folder = name.rpartition("/")[0]
    fs.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(hidden, compression=None) as out:
        out.write(content)
    fs.move(hidden, name)


def read_file(uri: str) -> bytes:
    fs, path = open_store(uri)
    with fs.open_input_stream(path, compression=None) as stream:
        return stream.read()


@dataclass
class Written(WriterCommitMessage):
    moves: list[tuple[str, str]]


class TarWriter(DataSourceWriter):
    """Rows of (key, member, content, source), sorted by key within a partition, to ``<path>/<key>``.

    A row without content has it in the file `source`, which the task that writes the archive opens itself. A task writes each archive under a hidden name; the driver gives the names out when all tasks are done,
    and deletes what an aborted job has written.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, rows: Iterator) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        moves: list[tuple[str, str]] = []
        key, out, tar = None, None, None

        def close() -> None:
            tar.close()
            hidden = f"{root}/.{uuid.uuid4().hex}"
            with fs.open_output_stream(hidden, compression=None) as stream:
                stream.write(out.getvalue())
            moves.append((hidden, f"{root}/{key}"))

        fs.create_dir(root, recursive=True)
        for row in rows:
            if row.key != key:
                if tar:
                    close()
                key, out = row.key, io.BytesIO()
                tar = tarfile.open(fileobj=out, mode="w", format=tarfile.PAX_FORMAT)
            content = read_file(row.source) if row.content is None and row.source else bytes(row.content)
            info = tarfile.TarInfo(row.member)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
        if tar:
            close()
        return Written(moves)

    def commit(self, messages: list[Written | None]) -> None:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for hidden, name in (m for x in messages if x for m in x.moves):
            fs.create_dir(name.rpartition("/")[0], recursive=True)
            fs.move(hidden, name)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for hidden, _ in (m for x in messages if x for m in x.moves):
            fs.delete_file(hidden)


class TarSource(DataSource):
    """``df.write.format("framewright-tar").mode("append").save(uri)`` for frames of (key, member, content)."""

    @classmethod
    def name(cls) -> str:
        return "framewright-tar"

    def schema(self) -> str:
        return "key string, member string, content binary, source string"

    def writer(self, schema, overwrite: bool) -> TarWriter:
        return TarWriter(self.options["path"])


def write_tars(members: DataFrame, uri: str) -> None:
    """Write (key, member, content or source) as archives; a key's rows meet in one task, in the order of their names.

    With `source`, the name of a file, only names are shuffled and the archive's task reads the contents.

    An archive is held in memory while it grows, so keys have to be dealt by number, as `operators.sequence`
    and W6 addresses do. `uri` may be of any store that pyarrow opens, such as s3.
    """
    spark: SparkSession = members.sparkSession
    spark.dataSource.register(TarSource)
    given = [F.col(c) if c in members.columns else F.lit(None).cast(t).alias(c) for c, t in (("content", "binary"), ("source", "string"))]
    rows = members.select("key", "member", *given).repartition("key").sortWithinPartitions("key", "member")
    rows.write.format("framewright-tar").mode("append").save(uri)


def write_files(files: DataFrame, uri: str) -> int:
    """Write (name, content) as single files below `uri`, each whole or not at all; returns their number.

    A rerun of a task writes the same bytes to the same name, so retries are harmless.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(uri)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                store(fs, f"{root}/{name}", content.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    return files.select("name", "content").mapInArrow(run, "n long").groupBy().sum("n").first()[0] or 0


def read_tars(spark: SparkSession, uri: str) -> DataFrame:
    """archive, member and content of every file in the tar archives below `uri`; Spark lists and reads the archives."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar").load(uri)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with tarfile.open(fileobj=io.BytesIO(data.as_py())) as tar:
                    for info in tar:
                        yield pa.RecordBatch.from_pylist([{"archive": path, "member": info.name, "content": tar.extractfile(info).read()}])

    return files.select("path", "content").mapInArrow(run, "archive string, member string, content binary")
