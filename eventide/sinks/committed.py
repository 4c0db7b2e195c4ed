"""Sinks as data sources (B2, B7, T3): a print table and a table whose writes are
committed once.

``eventide_committed`` keeps Parquet files in a folder that all machines share
(``path``, any file system that Arrow opens).  A task writes a file of its own
under a name that no other attempt has and reports it; what is in the table is what
the driver then names in ``_commits/<write>``.  So a task that fails, or runs twice,
leaves files that no commit names; a stream's batch that is replayed finds its
commit and leaves the files of the replay out; an aborted write removes what it
wrote.  ``INSERT INTO``, batch and stream writers and readers work alike.

    CREATE TEMPORARY VIEW sink (id INT, total BIGINT) USING eventide_committed OPTIONS (path '...')
    INSERT INTO sink SELECT id, sum(vc) FROM source GROUP BY id

(A view goes on to show what was committed when it was first read; read the path
anew for more.  With a ``CREATE TABLE`` the path goes where it is used: ``INSERT INTO sink WITH
(path '...')``, because the catalog passes no options to sinks in Python.)

Streams that write to one table at the same time each need a ``writer`` option.
An overwrite names the commits that it replaces.

``eventide_print`` prints every row in the task that holds it.
"""

from __future__ import annotations

import json
import sys
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamWriter, DataSourceWriter, InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

COMMITTED, PRINT = "eventide_committed", "eventide_print"


class Folder:
    """Files and commits of a table."""

    def __init__(self, path: str):
        if not path:
            raise ValueError("the table needs a 'path' that all machines share")
        self.at = path.rstrip("/")

    def _open(self):
        return fs.FileSystem.from_uri(self.at if ":/" in self.at else f"file://{self.at}")

    def write(self, name: str, batches, schema: pa.Schema) -> int:
        system, base = self._open()
        system.create_dir(base, recursive=True)
        rows = 0
        with system.open_output_stream(f"{base}/{name}") as out, pq.ParquetWriter(out, schema) as writer:
            for batch in batches:
                writer.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema)], schema=schema))
                rows += batch.num_rows
        return rows

    def read(self, name: str):
        system, base = self._open()
        with system.open_input_file(f"{base}/{name}") as file:
            yield from pq.ParquetFile(file).iter_batches()

    def remove(self, names) -> None:
        system, base = self._open()
        for name in names:
            try:
                system.delete_file(f"{base}/{name}")
            except FileNotFoundError:
                pass

    def commits(self) -> dict[str, dict]:
        system, base = self._open()
        found = system.get_file_info(fs.FileSelector(f"{base}/_commits", allow_not_found=True))
        out = {}
        for info in found:
            if not info.base_name.startswith(".") and info.is_file:
                with system.open_input_stream(info.path) as file:
                    out[info.base_name] = json.loads(file.read())
        return out

    def commit(self, write: str, files: list[str], replaces: list[str] = ()) -> bool:
        """Names the files of a write; whether it had not been committed before.  The
        commit is written aside and moved to its name, so none is half there."""
        system, base = self._open()
        system.create_dir(f"{base}/_commits", recursive=True)
        place, aside = f"{base}/_commits/{write}", f"{base}/_commits/.{write}-{uuid.uuid4().hex}"
        if system.get_file_info(place).type != fs.FileType.NotFound:
            return False
        with system.open_output_stream(aside) as out:
            out.write(json.dumps({"files": sorted(files), "replaces": sorted(replaces)}).encode())
        system.move(aside, place)
        return True

    def files(self) -> list[str]:
        commits = self.commits()
        gone = {name for c in commits.values() for name in c["replaces"]}
        return sorted(f for name, c in commits.items() if name not in gone for f in c["files"])


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class _Task:
    def __init__(self, path: str, schema: StructType):
        self.folder, self.schema = Folder(path), to_arrow_schema(schema)

    def write(self, iterator):
        name = f"part-{uuid.uuid4().hex}.parquet"
        return Written(name, self.folder.write(name, iterator, self.schema))


def _names(messages) -> list[str]:
    return [m.name for m in messages if m is not None]


class CommittedWriter(_Task, DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        super().__init__(path, schema)
        self.overwrite = overwrite

    def commit(self, messages) -> None:
        old = list(self.folder.commits()) if self.overwrite else []
        self.folder.commit(f"write-{uuid.uuid4().hex}", _names(messages), old)

    def abort(self, messages) -> None:
        self.folder.remove(_names(messages))


class CommittedStreamWriter(_Task, DataSourceStreamArrowWriter):
    def __init__(self, path: str, schema: StructType, writer: str):
        super().__init__(path, schema)
        self.writer = writer

    def commit(self, messages, batchId: int) -> None:
        if not self.folder.commit(f"{self.writer}-{batchId:012d}", _names(messages)):
            self.folder.remove(_names(messages))         # a replay: the batch is there already

    def abort(self, messages, batchId: int) -> None:
        self.folder.remove(_names(messages))


class File(InputPartition):
    pass


class CommittedReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.folder, self.schema = Folder(path), to_arrow_schema(schema)

    def partitions(self):
        return [File(f) for f in self.folder.files()] or [File(None)]

    def read(self, partition: File):
        if partition.value is not None:
            for batch in self.folder.read(partition.value):
                yield batch.select(self.schema.names)


class CommittedTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return COMMITTED

    def _path(self) -> str:
        return self.options.get("path", "")

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema
        files = Folder(self._path()).files()
        if not files:
            raise ValueError("an empty table needs a declared schema")
        return from_arrow_schema(next(iter(Folder(self._path()).read(files[0]))).schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return CommittedReader(self._path(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return CommittedWriter(self._path(), schema, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return CommittedStreamWriter(self._path(), schema, self.options.get("writer", "stream"))


class _Printer:
    def __init__(self, label: str, to_stderr: bool):
        self.label, self.to_stderr = label, to_stderr

    def write(self, iterator):
        out = sys.stderr if self.to_stderr else sys.stdout
        for row in iterator:
            print(f"{self.label}{row}", file=out, flush=True)
        return WriterCommitMessage()


class PrintWriter(_Printer, DataSourceWriter):
    pass


class PrintStreamWriter(_Printer, DataSourceStreamWriter):
    pass


class PrintTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return PRINT

    def schema(self):
        raise ValueError("a print table needs a declared schema")

    def _printer(self, kind):
        options = self.options
        label = options.get("label", "")
        return kind(f"{label}> " if label else "", options.get("stderr", "false").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return self._printer(PrintWriter)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return self._printer(PrintStreamWriter)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CommittedTable)
    spark.dataSource.register(PrintTable)
