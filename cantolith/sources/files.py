"""A sink of files under names of the rows' own, and a source of cursor pages, as data sources of Spark."""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

DONE = "_SUCCESS"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the place in it."""
    own, at = fs.FileSystem.from_uri(path)
    return own, at.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    """How many files a task has written; their names, which may be millions, stay there."""

    number: int


class NamedFiles(DataSource):
    """Sink `named_files` of rows (name string, bytes binary): a file for each row in the folder of the save() call.

    Executors write each file beside its place and rename it, so that no reader sees half a file and
    a task that runs again writes over its own. The driver touches the folder alone: it marks it as
    done, or removes it if a task fails for good. A folder with files in it is refused, or emptied
    with mode overwrite. Names hold no slash and don't start with a dot; operators.matching.free_names
    makes them distinct. A null is an empty file.
    """

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, bytes binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _FileWriter(self.options["path"], overwrite)


class _FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path = path
        own, at = store(path)
        if own.get_file_info(at).type != fs.FileType.NotFound and own.get_file_info(fs.FileSelector(at)):
            if not overwrite:
                raise FileExistsError(f"{path} has files in it")
            own.delete_dir_contents(at)
        own.create_dir(at, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        own, at = store(self.path)
        number, part = 0, f"{at}/.{uuid.uuid4().hex}"
        try:
            for batch in iterator:
                for name, data in zip(batch.column("name"), batch.column("bytes"), strict=True):
                    name = name.as_py()
                    if not name or "/" in name or name.startswith("."):
                        raise ValueError(f"not a file's name: {name!r}")
                    with own.open_output_stream(part) as out:
                        out.write(data.as_buffer() if data.is_valid else b"")
                    own.move(part, f"{at}/{name}")
                    number += 1
        except BaseException:
            if own.get_file_info(part).type != fs.FileType.NotFound:
                own.delete_file(part)
            raise
        return Written(number)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        own, at = store(self.path)
        with own.open_output_stream(f"{at}/{DONE}"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Removes the folder; tasks that are being killed may still write for a moment, so it must stay away."""
        own, at = store(self.path)
        gone = 0
        for _ in range(100):
            if own.get_file_info(at).type == fs.FileType.NotFound:
                gone += 1
                if gone == 3:
                    return
            else:
                gone = 0
                with contextlib.suppress(OSError):
                    own.delete_dir(at)
            time.sleep(0.1)
        raise OSError(f"{self.path} could not be removed")


@dataclass
class Cursors(InputPartition):
    """Cursors first, first + step, ... before end."""

    first: int
    end: int
    step: int


class CursorPages(DataSource):
    """Source `cursor_pages` (page long, json string): answers of a paged service, one row a page.

    The first answer (cursor 0) tells `total` items and the `limit` of a page; the other cursors are
    known by it and read in parallel, option per_task (20) pages a partition. An answer that fails is
    asked for again, option tries (3) times in all, with a pause of option wait (0.1) seconds that
    doubles; then the task fails. Answers are files <path>/<cursor>.json of a folder that executors
    reach; a service overrides fetch(). No page is dropped: one without items is a row as well.
    """

    @classmethod
    def name(cls) -> str:
        return "cursor_pages"

    def schema(self) -> str:
        return "page long, json string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self)

    def fetch(self, cursor: int) -> str:
        own, at = store(self.options["path"])
        with own.open_input_stream(f"{at}/{cursor}.json") as answer:
            return answer.read().decode("utf-8")

    def answer(self, cursor: int) -> str:
        wait, tries = float(self.options.get("wait", "0.1")), int(self.options.get("tries", "3"))
        for k in range(tries):
            try:
                return self.fetch(cursor)
            except OSError:
                if k + 1 == tries:
                    raise
                time.sleep(wait * 2**k)
        raise ValueError("tries must be 1 at least")


class _PageReader(DataSourceReader):
    def __init__(self, source: CursorPages):
        self.source = source

    def partitions(self) -> list[Cursors]:
        first = json.loads(self.source.answer(0))
        limit, total = int(first.get("limit") or 0), int(first.get("total") or 0)
        if limit < 1:  # one page
            return [Cursors(0, 1, 1)]
        step = limit * int(self.source.options.get("per_task", "20"))
        return [Cursors(at, min(at + step, total), limit) for at in range(0, max(total, 1), step)]

    def read(self, partition: Cursors) -> Iterator[tuple[int, str]]:
        for cursor in range(partition.first, max(partition.end, partition.first + 1), partition.step):
            yield cursor // partition.step, self.source.answer(cursor)


def dealt(df: DataFrame, name: str) -> DataFrame:
    """df by a hash of its files' names, over as many tasks as the session has for a shuffle: small rows are merged to few, though each is a file."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(name))


def contents(names: DataFrame, path: str) -> DataFrame:
    """(name, length, content) of the files of a folder that names(name) holds.

    Executors open each by its name; nobody lists the folder, which takes a driver as long and as much memory as
    it has files, and Spark's readers plan a task for every few of them. A file that is missing fails the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = store(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                few = batch.column(0).slice(k, 512)
                data = []
                for name in few.to_pylist():
                    with own.open_input_stream(f"{at}/{name}") as f:
                        data.append(f.read())
                yield pa.record_batch([few, pa.array([len(x) for x in data], pa.int64()), pa.array(data, pa.binary())], ["name", "length", "content"])

    return dealt(names.select("name"), "name").mapInArrow(run, "name string, length long, content binary")


def register(spark: SparkSession) -> SparkSession:
    """Makes both known to the session."""
    for source in (NamedFiles, CursorPages):
        spark.dataSource.register(source)
    return spark
