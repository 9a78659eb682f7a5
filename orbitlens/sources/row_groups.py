"""Archives by their row groups: a reader whose partitions are runs of row groups, a writer of named chunk files.

``row_groups`` reads footers when a query is planned and makes one partition of every run of ``groups_per_chunk`` row
groups of a file, or of several such runs where the footer is large; groups beyond the cap are in no partition, so they are never read. ``chunk_files`` writes the rows
of a chunk into one file under the name they carry; a name that ends in "/" is a folder, and every run of its rows
becomes a file there. Read and written together, a chunk goes from file to file in one
task, without a shuffle. Files appear under their names only when the job commits. ``footers`` lists row groups from
footers alone.

Both sides open files through Arrow, so paths are local or in a store Arrow knows (s3, gs, hdfs, abfs); ``minio``
prefixes and ``s3a`` count as s3.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructType

from orbitlens.functions.scalars import CHUNK_FILE_FORMAT, OBJECT_STORE_PREFIX

#: columns a chunk's rows carry: where they come from and which file they go to
PLACE = (("archive", StringType()), ("year", IntegerType()), ("chunk", IntegerType()), ("stop", IntegerType()),
         ("file_name", StringType()))
READERS = 16
#: row groups from which on a file is dealt to a limited number of tasks, and that number
LARGE_FOOTER, FOOTER_TASKS = 4_096, 16
#: chunks of a task at most, since a writer keeps their files open
MOST_CHUNKS = 64
#: footers beyond this are read one at a time when a query is planned
LARGE_FOOTER_BYTES = 1 << 20


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path inside it."""
    path = re.sub(OBJECT_STORE_PREFIX, "s3://", path)
    path = re.sub("^s3a://", "s3://", path)
    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), path.rstrip("/") or "/"
    return fs.FileSystem.from_uri(path.rstrip("/"))


def exists(path: str) -> bool:
    system, inner = store(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def remove(path: str) -> None:
    """Delete a folder and what is below it."""
    system, inner = store(path)
    system.delete_dir(inner)


def parquet_files(path: str) -> list[str]:
    """Paths of all Parquet files of a folder, in order; a file is itself."""
    system, inner = store(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [inner]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    below = [f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".parquet")]
    hidden = [any(part[:1] in "_." for part in p[len(inner):].strip("/").split("/")) for p in below]
    return sorted(p for p, h in zip(below, hidden) if not h)


def year_of(path: str, below: str) -> int | None:
    """The first four digits of the path below a folder; names that Spark gives to part files name no year."""
    rest = re.sub(r"(^|/)part-[^/]*$", "", path[len(below):] if path != below else path.rsplit("/", 1)[-1])
    found = re.search(r"\d{4}", rest)
    return int(found.group()) if found else None


@dataclass
class Chunk:
    """Row groups ``first`` to ``stop`` (exclusive) of a file."""

    path: str
    year: int
    first: int
    stop: int
    file_name: str


@dataclass
class Run(InputPartition):
    """Consecutive chunks of one file, which a task reads with one look at the footer."""

    chunks: list[Chunk]


def footer_bytes(path: str, system: fs.FileSystem) -> int:
    """The length of a footer, which the file's last eight bytes hold."""
    with system.open_input_file(path) as file:
        size = file.size()
        return int.from_bytes(file.read_at(4, size - 8), "little") if size >= 12 else 0


def count_groups(paths: list[str], system: fs.FileSystem) -> list[int]:
    """The row groups of files. Footers are held 16 at a time, and large ones one at a time."""
    count = lambda p: pq.read_metadata(p, filesystem=system).num_row_groups
    with ThreadPoolExecutor(READERS) as pool:
        large = list(pool.map(lambda p: footer_bytes(p, system) > LARGE_FOOTER_BYTES, paths))
        small = dict(zip([p for p, x in zip(paths, large) if not x], pool.map(count, [p for p, x in zip(paths, large) if not x])))
    return [count(p) if x else small[p] for p, x in zip(paths, large)]


def plan_runs(path: str, groups_per_chunk: int, group_limit: int | None) -> list[Run]:
    """The chunks of all archives of a folder that name a year, one to a task.

    Every task holds its file's whole footer, so a file of very many row groups goes to few tasks: each takes chunks of
    1 / FOOTER_TASKS of its row groups, or MOST_CHUNKS.

    A chunk's file lies in the folder of its year, and where a year has several archives, in one more for
    the archive.
    """
    system, inner = store(path)
    named = [(p, year_of(p, inner)) for p in parquet_files(path)]
    named = [(p, y) for p, y in named if y is not None]
    counts = count_groups([p for p, _ in named], system)
    years = [y for _, y in named]
    out = []
    for (file, year), total in zip(named, counts):
        groups = total if group_limit is None else min(total, group_limit)
        each = 1 if total < LARGE_FOOTER else min(MOST_CHUNKS, math.ceil(total / FOOTER_TASKS / groups_per_chunk))
        below = re.sub(r"[^A-Za-z0-9_.-]+", "_", file[len(inner):].strip("/").removesuffix(".parquet"))
        folder = f"{year}" if years.count(year) == 1 else f"{year}/{below}"
        chunks = []
        for first in range(0, groups, groups_per_chunk):
            stop = min(first + groups_per_chunk, groups)
            chunks.append(Chunk(file, year, first, stop, f"{folder}/{CHUNK_FILE_FORMAT % (first, stop)}"))
        out += [Run(chunks[i:i + each]) for i in range(0, len(chunks), each)]
    return out


class RowGroups(DataSource):
    """Options: path, groups_per_chunk (10), group_limit (none), columns (a JSON list; all)."""

    @classmethod
    def name(cls) -> str:
        return "row_groups"

    def schema(self) -> StructType:
        files = parquet_files(self.options["path"])
        if not files:
            raise ValueError(f"no Parquet file below {self.options['path']}")
        found = pq.read_schema(files[0], filesystem=store(self.options["path"])[0])
        names = json.loads(self.options.get("columns", "null")) or found.names
        out = from_arrow_schema(pa.schema([found.field(n) for n in names]))
        clash = {n for n, _ in PLACE} & set(out.names)
        if clash:
            raise ValueError(f"the archive has columns {sorted(clash)}")
        for name, kind in PLACE:
            out = out.add(name, kind)
        return out

    def reader(self, schema: StructType) -> DataSourceReader:
        return RowGroupReader(self.options, [n for n in schema.names if n not in dict(PLACE)])


class RowGroupReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.path, self.columns = options["path"], columns
        self.per_chunk = int(options.get("groups_per_chunk", 10))
        self.limit = int(options["group_limit"]) if "group_limit" in options else None

    def partitions(self) -> list[InputPartition]:
        return plan_runs(self.path, self.per_chunk, self.limit)

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an archive folder without chunks has one empty partition
            return
        with store(self.path)[0].open_input_file(partition.chunks[0].path) as source:
            file = pq.ParquetFile(source)
            for c in partition.chunks:
                place = {"archive": c.path, "year": c.year, "chunk": c.first, "stop": c.stop, "file_name": c.file_name}
                for batch in file.iter_batches(row_groups=list(range(c.first, c.stop)), columns=self.columns):
                    batch = batch.select(self.columns)
                    more = [pa.array([v] * batch.num_rows, pa.string() if isinstance(v, str) else pa.int32()) for v in place.values()]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*self.columns, *place])


@dataclass
class Written(WriterCommitMessage):
    """(temporary path, name below the target) of the files of a task."""

    files: list[tuple[str, str]]


class ChunkFiles(DataSource):
    """Writes rows under the names in their ``file_name``; the columns of ``PLACE`` are not part of the files."""

    @classmethod
    def name(cls) -> str:
        return "chunk_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ChunkWriter(self.options["path"], overwrite)


class ChunkWriter(DataSourceArrowWriter):
    """A file is written by one task, below a folder of the job, and moved to its name by the commit.

    Files with names of their own stay open until the task ends; those in folders only as long as their rows follow
    one another.
    """

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def _folder(self) -> str:
        return f"{store(self.path)[1]}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system = store(self.path)[0]
        task = uuid.uuid4().hex
        mine = f"{self._folder()}/{task}"
        system.create_dir(mine, recursive=True)
        writers: dict[str, pq.ParquetWriter] = {}
        files: list[tuple[str, str]] = []
        try:
            for batch in iterator:
                names = batch.column("file_name").dictionary_encode()
                data = batch.select([n for n in batch.schema.names if n not in dict(PLACE)])
                for code, name in enumerate(names.dictionary.to_pylist()):
                    rows = data.filter(pc.equal(names.indices, code))
                    if name not in writers:
                        for done in [n for n in writers if n.endswith("/")]:
                            writers.pop(done).close()
                        temporary = f"{mine}/{len(files):05d}.parquet"
                        files.append((temporary, f"{name}part-{task}-{len(files):05d}.parquet" if name.endswith("/") else name))
                        writers[name] = pq.ParquetWriter(temporary, rows.schema, filesystem=system)
                    writers[name].write_batch(rows)
        finally:
            for writer in writers.values():
                writer.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, target = store(self.path)
        files = [f for m in messages if m for f in m.files]
        names = [name for _, name in files]
        with ThreadPoolExecutor(READERS) as pool:
            found = pool.map(lambda n: system.get_file_info(f"{target}/{n}").type, names)
            taken = [n for n, kind in zip(names, found) if kind != fs.FileType.NotFound]
        twice = {n for n in names if names.count(n) > 1} if len(set(names)) < len(names) else set()
        if twice or (taken and not self.overwrite):
            self.abort(messages)
            raise ValueError(f"chunk files written by two tasks: {sorted(twice)}" if twice else f"chunk files exist: {taken}")
        def place(file: tuple[str, str]) -> None:
            system.create_dir(f"{target}/{file[1].rpartition('/')[0]}", recursive=True)
            system.move(file[0], f"{target}/{file[1]}")

        with ThreadPoolExecutor(READERS) as pool:
            list(pool.map(place, files))
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system = store(self.path)[0]
        if system.get_file_info(self._folder()).type == fs.FileType.Directory:
            system.delete_dir(self._folder())


class Footers(DataSource):
    """One row per row group, from footers alone. Options: path, column (whose range is given, in microseconds)."""

    @classmethod
    def name(cls) -> str:
        return "footers"

    def schema(self) -> str:
        return "path string, row_group int, rows bigint, bytes bigint, low bigint, high bigint"

    def reader(self, schema: StructType) -> DataSourceReader:
        return FooterReader(self.options)


@dataclass
class Files(InputPartition):
    paths: list[str]


class FooterReader(DataSourceReader):
    FILES = 64

    def __init__(self, options: dict[str, str]):
        self.path, self.column = options["path"], options.get("column")

    def partitions(self) -> list[InputPartition]:
        files = parquet_files(self.path)
        return [Files(files[i:i + self.FILES]) for i in range(0, len(files), self.FILES)]

    def read(self, partition: Files) -> Iterator[tuple]:
        system = store(self.path)[0]
        for path in partition.paths if partition else []:
            footer = pq.read_metadata(path, filesystem=system)
            at = footer.schema.names.index(self.column) if self.column else None
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                seen = group.column(at).statistics if at is not None else None
                known = seen is not None and seen.has_min_max
                yield (path, g, group.num_rows, group.total_byte_size, *[_micros(x) if known else None for x in (
                    (seen.min, seen.max) if known else (None, None))])


def _micros(value) -> int:
    return pa.scalar(value, pa.timestamp("us")).value


def register(spark: SparkSession) -> None:
    """Make the three formats known to a session."""
    for source in (RowGroups, ChunkFiles, Footers):
        spark.dataSource.register(source)


def rechunk(spark: SparkSession, source: str, target: str, groups_per_chunk: int = 10, group_limit: int | None = None,
            columns: list[str] | None = None, mode: str = "append") -> None:
    """Cut all archives below ``source`` into named files of ``groups_per_chunk`` row groups below ``target``."""
    register(spark)
    reader = spark.read.format("row_groups").option("groups_per_chunk", groups_per_chunk)
    if group_limit is not None:
        reader = reader.option("group_limit", group_limit)
    if columns:
        reader = reader.option("columns", json.dumps(columns))
    reader.load(source).write.format("chunk_files").mode(mode).save(target)


def list_files(spark: SparkSession, path: str, ts: str | None = None) -> DataFrame:
    """Files below a folder with their row groups, rows and range of ``ts``, without reading rows."""
    register(spark)
    reader = spark.read.format("footers")
    found = (reader.option("column", ts) if ts else reader).load(path)
    return found.groupBy("path").agg(
        F.count("*").alias("row_groups"), F.sum("rows").alias("rows"),
        F.timestamp_micros(F.min("low")).cast("timestamp_ntz").alias("start"),
        F.timestamp_micros(F.max("high")).cast("timestamp_ntz").alias("end"))
