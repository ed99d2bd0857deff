"""Numbered Parquet files of bounded size, written once.

A data source writer: every task cuts the rows that it gets into files by the real bytes of a column, in a folder of its own; when
all tasks are done the files are numbered, by the counts of the tasks ahead and on from the highest number that is there, and
moved to their places. What is to be moved is noted first, so a move that was cut short is ended by the next run.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes of an output file, about. Fixed value.
SHARD = 400_000_000
#: Bytes of a row group at least.
GROUP = 32 << 20
_NUMBERED = re.compile(r"(\d{5,})\.parquet")


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if re.match(r"[A-Za-z][A-Za-z0-9+.\-]+:", path) else f"file://{path}")


def cuts(sizes: np.ndarray, held: int, target: int) -> list[int]:
    """Where new files begin among rows of some sizes, ``held`` bytes being in the open one: no file over target but one of a single row."""
    total = np.cumsum(sizes)
    out, at, before = [], 0, -held
    while at < len(sizes):
        at = max(int(np.searchsorted(total, before + target, "right")), at if not out and held else at + 1)
        if at >= len(sizes):
            break
        out.append(at)
        before = int(total[at - 1]) if at else 0
    return out


class _Files(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, str, int, int]]):
        self.files = files  # kind, staged path, rows, bytes


class _Open:
    """The files of one kind in one task."""

    def __init__(self, system: fs.FileSystem, stage: str, kind: str, schema: pa.Schema, column: str, target: int):
        self.system, self.stage, self.kind, self.schema, self.column, self.target = system, stage, kind, schema, column, target
        self.files: list[tuple[str, str, int, int]] = []
        self.writer: pq.ParquetWriter | None = None
        self.waiting: list[pa.Table] = []

    def add(self, rows: pa.Table) -> None:
        sizes = pc.fill_null(pc.binary_length(rows[self.column]), 0).to_numpy().astype(np.int64)
        edges = [0, *cuts(sizes, self.bytes if self.writer else 0, self.target), len(sizes)] if len(sizes) else [0]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            if k:
                self.close()
            if b > a:
                self._put(rows.slice(a, b - a), int(sizes[a:b].sum()))

    def _put(self, rows: pa.Table, size: int) -> None:
        if self.writer is None:
            self.path, self.rows, self.bytes = f"{self.stage}/{uuid.uuid4().hex}.parquet", 0, 0
            self.writer = pq.ParquetWriter(self.path, self.schema, filesystem=self.system, compression="snappy")
        self.rows, self.bytes = self.rows + len(rows), self.bytes + size
        self.waiting.append(rows)
        if sum(t.nbytes for t in self.waiting) >= GROUP:
            self._flush()

    def _flush(self) -> None:
        if self.waiting:
            self.writer.write_table(pa.concat_tables(self.waiting))
            self.waiting = []

    def close(self) -> None:
        if self.writer is not None:
            self._flush()
            self.writer.close()
            self.files.append((self.kind, self.path, self.rows, self.bytes))
            self.writer = None


class _ShardWriter(DataSourceArrowWriter):
    def __init__(self, places: dict[str, tuple[str, str]], target: int):
        """places: kind -> folder and the column whose bytes count. Rows have a column kind unless there is one place alone."""
        self.places, self.target, self.run = places, target, uuid.uuid4().hex

    def _stage(self, kind: str) -> tuple[fs.FileSystem, str, str]:
        system, root = _place(self.places[kind][0])
        return system, root, f"{root}/.stage-{self.run}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        open_: dict[str, _Open] = {}
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for kind, (_, column) in self.places.items():
                own = rows.filter(pc.equal(rows["kind"], kind)) if len(self.places) > 1 else rows
                other = {c for k, (_, c) in self.places.items() if k != kind} | {"kind"} if len(self.places) > 1 else set()
                own = own.select([c for c in own.column_names if c not in other])
                if not len(own):
                    continue
                if kind not in open_:
                    system, _, stage = self._stage(kind)
                    system.create_dir(stage, recursive=True)
                    open_[kind] = _Open(system, stage, kind, own.schema, column, self.target)
                open_[kind].add(own)
        for one in open_.values():
            one.close()
        return _Files([x for one in open_.values() for x in one.files])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        for kind in self.places:
            system, root, stage = self._stage(kind)
            system.create_dir(f"{root}/_shards", recursive=True)
            finish(system, root)
            there = [int(m[1]) for x in system.get_file_info(fs.FileSelector(root)) if (m := _NUMBERED.fullmatch(x.base_name))]
            files = [f for m in messages if m is not None for f in m.files if f[0] == kind]  # the tasks in order
            moves = [(staged, f"{root}/{n:05d}.parquet", rows, size) for n, (_, staged, rows, size) in enumerate(files, max(there, default=0) + 1)]
            draft = f"{root}/_shards/.{self.run}"
            with system.open_output_stream(draft) as f:
                f.write(json.dumps({"stage": stage, "moves": moves}).encode())
            system.move(draft, f"{root}/_shards/{self.run}.json")
            finish(system, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for kind in self.places:
            system, _, stage = self._stage(kind)
            if system.get_file_info(stage).type != fs.FileType.NotFound:
                system.delete_dir(stage)


def finish(system: fs.FileSystem, root: str) -> None:
    """Move what is noted and not moved yet."""
    for note in system.get_file_info(fs.FileSelector(f"{root}/_shards")):
        if not note.base_name.endswith(".json"):
            continue
        with system.open_input_stream(note.path) as f:
            noted = json.loads(f.read())
        if system.get_file_info(noted["stage"]).type == fs.FileType.NotFound:
            continue
        for staged, final, *_ in noted["moves"]:
            if system.get_file_info(staged).type != fs.FileType.NotFound:
                system.move(staged, final)
        system.delete_dir(noted["stage"])


class Shards(DataSource):
    """Format ``shards``: options places (JSON: kind -> folder, column) and target."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _ShardWriter({k: tuple(v) for k, v in json.loads(self.options["places"]).items()}, int(self.options["target"]))


def write_shards(df: DataFrame, places: dict[str, tuple[str, str]], target: int = SHARD) -> None:
    df.sparkSession.dataSource.register(Shards)
    df.write.format("shards").options(places=json.dumps(places), target=target).mode("append").save()


def shard_by_size(df: DataFrame, path: str, column: str, target: int = SHARD) -> None:
    """Append df to numbered files (00001.parquet, ...) below path, each of at most ``target`` bytes of ``column`` (null: none), but that a
    longer row has a file to itself. Rows are neither counted ahead nor shuffled; a task makes at least one file of what it has. The folder
    is one that all nodes reach (a mounted one, or a store that pyarrow knows by its URI), and has one writer at a time.
    """
    write_shards(df, {"": (path, column)}, target)
