"""Files with exact bytes and names of their own, written by the executors.

Spark's file writers name their files themselves and write text or rows. The
data source here (Python Data Source API) writes one file per row of
``(file, content)``: ``content`` goes byte for byte to the path ``file`` below
the target folder. A file is written under a temporary name beside its place
and renamed, so a reader sees it whole or not at all, and a task that runs
again writes the same bytes to the same place. Tasks report how many files and
bytes they wrote; the commit puts the sums into ``_SUCCESS``.

The target may be on any file system that pyarrow reaches by its scheme; a
path without one, or ``file:``, is a folder that all executors share.

Defined cases: a null content is an empty file; a path that is null, empty,
absolute, or that leaves the folder (``..``) fails the write; so do two rows
of one path, unless the caller states that paths are unique; an empty table
writes ``_SUCCESS`` alone; other columns are ignored.

A folder of many small files costs by the file, not by the byte: files are
dealt over the tasks by their paths, listed by tasks (:func:`list_files`) and
read by tasks, and neither rows nor names gather on the driver. Where pyarrow
does not reach the store of a folder that is read, Spark's reader lists it.
"""

from __future__ import annotations

import itertools
import json
import os
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceWriter, WriterCommitMessage

from sigfleet.session import setting, work_path

# The writer travels to the Python workers whole: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "named_files"
SUCCESS = "_SUCCESS"
# Rows and bytes of an Arrow batch that is written, and bytes of one that is
# read; a batch passes its bytes by one file at most.
WRITE_ROWS = 16
WRITE_BYTES = 4 << 20
READ_BYTES = 4 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Spark's source that gives so many rows with each trigger, and where a task finds its query.
CLOCK = "rate-micro-batch"
QUERY_ID = "sql.streaming.queryId"


def checked_path(file: str | None) -> str:
    """``file`` if it stays below a folder, else an error."""
    parts = (file or "").split("/")
    if any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"not a path below the folder: {file!r}")
    return file


def _place(path: str):
    """``(file system, folder)`` of a target path."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file://"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def write_whole(path: str, file: str, content: bytes) -> None:
    """One file below ``path``, visible only when complete."""
    system, folder = _place(path)
    target = f"{folder}/{file}"
    above, _, name = target.rpartition("/")
    system.create_dir(above, recursive=True)
    part = f"{above}/.{uuid.uuid4().hex}.part"
    try:
        with system.open_output_stream(part, compression=None) as out:
            out.write(content)
        system.move(part, target)
    except BaseException:
        if system.get_file_info(part).is_file:
            system.delete_file(part)
        raise


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator) -> Written:
        files = size = 0
        for row in iterator:
            content = row["content"] or b""
            write_whole(self.path, checked_path(row["file"]), content)
            files, size = files + 1, size + len(content)
        return Written(files, size)

    def commit(self, messages: list) -> None:
        done = [m for m in messages if m is not None]
        total = {"files": sum(m.files for m in done), "bytes": sum(m.bytes for m in done)}
        write_whole(self.path, SUCCESS, json.dumps(total).encode())

    def abort(self, messages: list) -> None:
        """Whole files may stay; without ``_SUCCESS`` the folder is incomplete."""


class NamedFilesArrowWriter(NamedFilesWriter, DataSourceArrowWriter):
    """The writer fed by Arrow batches: one content at a time becomes an object."""

    def write(self, iterator: Iterator) -> Written:
        return super().write(
            {"file": file.as_py(), "content": content.as_buffer()}
            for batch in iterator
            for file, content in zip(batch.column("file"), batch.column("content"), strict=True)
        )


class NamedFiles(DataSource):
    """``df.write.format("named_files").option("path", …)`` of ``file, content``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, content binary"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesArrowWriter(self.options["path"])


def write_named_files(df: DataFrame, path: str, unique: bool = False) -> None:
    """Write ``df(file, content)`` below ``path``.

    ``unique`` states that no two rows have the same path; otherwise that is
    checked first on the paths alone.
    """
    if not unique:
        twice = df.groupBy("file").count().where("count > 1").select("file").limit(3).collect()
        if twice:
            raise ValueError(f"several rows for one file: {[r.file for r in twice]}")
    spark = df.sparkSession
    spark.dataSource.register(NamedFiles)
    rows = dealt(df.select("file", F.col("content").cast("binary").alias("content")))
    with setting(spark, BATCH_ROWS, WRITE_ROWS), setting(spark, BATCH_BYTES, WRITE_BYTES):  # contents may be large
        rows.write.format(FORMAT).mode("append").option("path", path).save()


def dealt(files: DataFrame) -> DataFrame:
    """Rows dealt over the tasks by ``file``, however few bytes they have."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark shows it in file names (scheme and all)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def path_below(spark: SparkSession, root: str, column: str = "path"):
    """The part of a file's full path below the folder ``root``."""
    return F.expr(f"substring({column}, {len(qualified(spark, root)) + 2})")


def _reached(path: str) -> bool:
    """Whether tasks reach the file system of a qualified path by pyarrow."""
    try:
        _place(path)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


def _entries(path: str, below: str, wanted=None) -> Iterator:
    """``(path below the root, length, is a folder, time of change)`` of what
    lies in a folder, or of its ``wanted`` names; the time is in milliseconds."""
    from pyarrow import fs

    system, root = _place(path)
    folder, lead = (f"{root}/{below}", f"{below}/") if below else (root, "")
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(folder) as there:
            for x in there:
                if wanted and not wanted(x.name):
                    continue
                if x.is_dir():
                    yield lead + x.name, 0, True, 0
                    continue
                try:
                    st = x.stat()
                except FileNotFoundError:  # gone since
                    continue
                yield lead + x.name, st.st_size, False, st.st_mtime_ns // 1_000_000
    else:
        for x in system.get_file_info(fs.FileSelector(folder)):
            if not wanted or wanted(x.base_name):
                yield lead + x.base_name, x.size or 0, x.type == fs.FileType.Directory, (x.mtime_ns or 0) // 1_000_000


def _top(path: str, enough: int) -> Iterator:
    """Files and folders down to the level that has ``enough`` folders; the
    folders above that level are left out."""
    level = [""]
    while level:
        below, many = [], False
        for folder in level:
            for x in _entries(path, folder):
                if many or not x[2]:
                    yield x
                else:
                    below.append(x)
                    if many := len(below) >= enough:
                        yield from below
        if many:
            return
        level = [x[0] for x in below]


def _files(path: str, below: str) -> Iterator:
    """Every file at any depth below a folder."""
    for x in _entries(path, below):
        if x[2]:
            yield from _files(path, x[0])
        else:
            yield x


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _shown(file: str, length: int) -> bool:
    """Whether a file counts; an empty one is judged by its own name."""
    parts = file.split("/")
    return not any(map(_hidden, parts)) if length else not parts[-1].startswith(("_", "."))


def _batches(rows: Iterator, names: tuple[str, ...], types: tuple, most: int = 10_000) -> Iterator:
    """Rows as Arrow batches of ``most`` rows."""
    import pyarrow as pa

    while part := list(itertools.islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types, strict=True)], list(names))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, length`` of every file below ``path``, as it is now.

    One task lists the upper levels until there are folders enough for all
    tasks, which list what is below; the list is kept as a table in the shared
    folder, so that later files do not enter it.
    """
    root = qualified(spark, path)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def top(batches):
        import pyarrow as pa

        for _ in batches:
            upper = (x[:3] for x in _top(root, tasks))
            yield from _batches(upper, ("file", "length", "folder"), (pa.string(), pa.int64(), pa.bool_()))

    def rest(batches):
        import pyarrow as pa

        def rows():
            for batch in batches:
                for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for file, length, *_ in _files(root, x[0]) if x[2] else (x,):
                        if _shown(file, length):
                            yield file, length

        yield from _batches(rows(), ("file", "length"), (pa.string(), pa.int64()))

    above = spark.range(0, 1, 1, 1).mapInArrow(top, "file string, length long, folder boolean")
    kept = work_path(spark, "file-list")
    dealt(above).mapInArrow(rest, "file string, length long").write.parquet(kept)
    return spark.read.schema("file string, length long").parquet(kept)


def listing_tasks(spark: SparkSession) -> int:
    """Tasks that list a folder for a stream."""
    return max(32, 2 * spark.sparkContext.defaultParallelism)


def _landed(path: str, wanted) -> Iterator:
    """``file, length, modified`` of the files that show below a folder, in the
    entries of the root that are ``wanted``. A folder that goes away meanwhile
    has no files."""
    for x in _entries(path, "", lambda name: not _hidden(name) and wanted(name)):
        folders = [x]
        while folders:
            file, length, is_dir, modified = folders.pop()
            if not is_dir:
                yield file, length, modified
                continue
            try:
                folders.extend(_entries(path, file, lambda name: not _hidden(name)))
            except FileNotFoundError:
                continue


def _kept(path: str, name: str, schema, batches: Callable[[], Iterator]) -> Iterator:
    """Arrow batches by way of a file below ``path`` that is written once, so
    that a task that runs again gives the same; files of other names go."""
    import pyarrow as pa
    from pyarrow import fs

    system, folder = _place(path)
    system.create_dir(folder, recursive=True)
    if not system.get_file_info(f"{folder}/{name}").is_file:
        part = f"{folder}/.{uuid.uuid4().hex}.part"
        with system.open_output_stream(part, compression=None) as out, pa.ipc.new_stream(out, schema) as to:
            for batch in batches():
                to.write_batch(batch)
        system.move(part, f"{folder}/{name}")
    with system.open_input_stream(f"{folder}/{name}", compression=None) as f, pa.ipc.open_stream(f) as back:
        yield from back
    for x in system.get_file_info(fs.FileSelector(folder)):
        if x.base_name != name and not x.base_name.endswith(".part"):
            system.delete_file(x.path)


def listed_by_tasks(spark: SparkSession, path: str) -> bool:
    """Whether :func:`stream_new_files` reaches a folder and its own lists."""
    return _reached(qualified(spark, path)) and _reached(qualified(spark, work_path(spark, "landed-lists")))


def stream_new_files(spark: SparkSession, path: str) -> DataFrame:
    """A stream of ``file, length, modified`` (milliseconds): every file below
    ``path`` once, by the trigger that first finds it.

    With each trigger, :func:`listing_tasks` tasks list the folder, each the
    entries of the root whose names fall to it, and a state store, dealt by
    name, leaves out what earlier triggers found: neither list lies with the
    driver, and a trigger takes all that is new. A clock starts the tasks, so
    there is a batch per trigger, also when nothing has landed.

    What a task lists is kept in the shared folder until its next trigger. A
    task that has to run again gives the same list: a file that lands in
    between waits for the next trigger instead of being noted and not read.
    """
    root, kept = qualified(spark, path), qualified(spark, work_path(spark, "landed-lists"))
    tasks = listing_tasks(spark)

    def listed(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        query = TaskContext.get().getLocalProperty(QUERY_ID) or "query"
        names, types = ("file", "length", "modified"), (pa.string(), pa.int64(), pa.int64())
        schema = pa.schema(list(zip(names, types, strict=True)))
        for batch in batches:
            for n, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                here = n % tasks
                mine = lambda name, here=here: zlib.crc32(os.fsencode(name)) % tasks == here
                rows = lambda mine=mine: _batches(_landed(root, mine), names, types)
                yield from _kept(f"{kept}/{query}/{here}", f"{n}-{at}", schema, rows)

    clock = spark.readStream.format(CLOCK).option("rowsPerBatch", tasks).option("numPartitions", tasks).load()
    ticks = clock.select("value", F.unix_millis(F.current_timestamp()).alias("at"))
    found = ticks.mapInArrow(listed, "file string, length long, modified long")
    return found.dropDuplicates(["file"])


def with_content(files: DataFrame, path: str) -> DataFrame:
    """``files(file, length)`` below ``path`` with their bytes as ``content``;
    ``modified`` comes along where the list has it."""
    root = qualified(files.sparkSession, path)
    names = ["file", "length", *(c for c in files.columns if c == "modified")]

    def read(batches):
        import pyarrow as pa

        system, folder = _place(root)

        def batch_of(rows):
            types = (pa.string(), *[pa.int64()] * (len(names) - 1), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], [*names, "content"])

        rows, size = [], 0
        for batch in batches:
            for listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with system.open_input_stream(f"{folder}/{listed[0]}", compression=None) as f:
                    content = f.read()
                if rows and (size + len(content) > READ_BYTES or len(rows) >= 1000):
                    done, rows, size = batch_of(rows), [], 0
                    yield done
                rows.append((*listed, content))
                size += len(content)
        if rows:
            yield batch_of(rows)

    fields = ["file string", *(f"{c} long" for c in names[1:]), "content binary"]
    return dealt(files.select(*names)).mapInArrow(read, ", ".join(fields))


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, length, content`` of every file below ``path``, empty ones included."""
    if _reached(qualified(spark, path)):
        return with_content(list_files(spark, path), path)
    from sigfleet.sources.payloads import empty_files

    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = read.select("path", "length", "content").unionByName(
        empty_files(spark, path).select("path", F.lit(0).cast("long").alias("length"), F.lit(b"").cast("binary").alias("content"))
    )
    return files.select(path_below(spark, path).alias("file"), "length", "content")


def read_named_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, content`` of every file below ``path``, empty ones included."""
    return read_whole_files(spark, path).select("file", "content")
