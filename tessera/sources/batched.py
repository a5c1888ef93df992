"""``batched_rows``: a table written in batches of a fixed number of rows, on Spark's public data source API.

    spark.dataSource.register(BatchedRows)
    df.write.format("batched_rows").option("batch_rows", 100).mode("append").save(path)
    spark.read.format("batched_rows").schema(df.schema).load(path)

Each task sends its rows in batches of ``batch_rows`` (100 if not given); the
last batch of a task holds what is left. A task writes to a file of its own
(Arrow stream, one record batch for each batch of rows) and tells the driver its
name. The driver's commit lists the files of the successful tasks in one
manifest, which a single rename makes visible. What failed, repeated or
speculative tasks wrote is in no manifest, so nothing is lost and nothing counts
twice; an abort deletes what the tasks reported.

Paths are those of Arrow's file systems (local or shared folders, hdfs, s3).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

BATCH_ROWS = 100


def _open(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def in_batches(batches, rows: int):
    """The rows of Arrow batches, cut anew into batches of ``rows``; the last one may be smaller."""
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


@dataclass
class Written(WriterCommitMessage):
    """A task's file, relative to the table."""

    file: str | None
    rows: int
    batches: int


@dataclass
class Piece(InputPartition):
    file: str


class BatchedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch_rows: int, overwrite: bool):
        self.path, self.batch_rows, self.overwrite, self.job = path, batch_rows, overwrite, uuid.uuid4().hex

    def write(self, iterator) -> Written:
        import pyarrow as pa
        from pyspark import TaskContext

        files, root = _open(self.path)
        context = TaskContext.get()
        name = f"data/{self.job}-{context.partitionId() if context else 0}-{uuid.uuid4().hex}.arrow"
        sink = writer = None
        rows = batches = 0
        try:
            for batch in in_batches(iterator, self.batch_rows):
                if writer is None:
                    files.create_dir(f"{root}/data", recursive=True)
                    sink = files.open_output_stream(f"{root}/{name}")
                    writer = pa.ipc.new_stream(sink, batch.schema)
                writer.write_batch(batch)
                rows, batches = rows + batch.num_rows, batches + 1
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return Written(name if rows else None, rows, batches)

    def commit(self, messages) -> None:
        files, root = _open(self.path)
        done = [m for m in messages if m is not None and m.file]
        before = _manifests(files, root) if self.overwrite else []
        files.create_dir(f"{root}/commits", recursive=True)
        part, manifest = f"{root}/commits/.{self.job}", f"{root}/commits/{self.job}.json"
        with files.open_output_stream(part) as out:
            out.write(json.dumps({"files": [m.file for m in done], "rows": sum(m.rows for m in done),
                                  "batches": sum(m.batches for m in done), "instead_of": [n for n, _ in before]}).encode())
        files.move(part, manifest)

    def abort(self, messages) -> None:
        files, root = _open(self.path)
        for m in messages:
            if m is not None and m.file:
                files.delete_file(f"{root}/{m.file}")


def _manifests(files, root: str) -> list[tuple[str, dict]]:
    """(name, content) of the commits that count: those that no later one stands instead of."""
    from pyarrow import fs

    found = files.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    all_ = {}
    for f in found:
        if f.base_name.endswith(".json") and not f.base_name.startswith("."):
            with files.open_input_stream(f.path) as stream:
                all_[f.base_name] = json.loads(stream.read())
    gone = {n for m in all_.values() for n in m["instead_of"]}
    return sorted((n, m) for n, m in all_.items() if n not in gone)


class BatchedReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Piece]:
        files, root = _open(self.path)
        return [Piece(f) for _, m in _manifests(files, root) for f in m["files"]] or [Piece("")]

    def read(self, partition: Piece):
        import pyarrow as pa

        if not partition.file:
            return
        files, root = _open(self.path)
        with files.open_input_stream(f"{root}/{partition.file}") as stream:
            yield from pa.ipc.open_stream(stream)


class BatchedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "batched_rows"

    def schema(self):
        raise ValueError("batched_rows is read with a declared schema: spark.read.schema(...)")

    def reader(self, schema) -> BatchedReader:
        return BatchedReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> BatchedWriter:
        return BatchedWriter(self.options["path"], int(self.options.get("batch_rows", BATCH_ROWS)), overwrite)


def committed(path: str) -> dict[str, int]:
    """Rows and batches of a table's commits."""
    files, root = _open(path)
    found = [m for _, m in _manifests(files, root)]
    return {"commits": len(found), "rows": sum(m["rows"] for m in found), "batches": sum(m["batches"] for m in found)}
