"""A store of cells (row, family, qualifier, value) as a data source: parts that are read apart, filters that skip files, writes that commit or leave nothing.

    spark.dataSource.register(CellStore)
    df.write.format("cells").mode("append").save(path)
    spark.read.format("cells").load(path).filter("family = 'f' and row >= '10'")

Below the path lie data files, one or more a task and family, and manifests. A commit writes one manifest that names the files of all tasks; readers see files that a
manifest names and no others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

COLUMNS = ("row", "family", "qualifier", "value")
#: Rows of a data file; a task starts another one when a family's file is full.
FILE_ROWS = 1_000_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def listed(path: str) -> list[dict]:
    """The files that count, as the manifests name them: those behind the last one that replaced all before it."""
    store, root = opened(path)
    found = store.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    names = sorted(f.path for f in found if f.path.endswith(".json"))
    files: list[dict] = []
    for name in names:
        with store.open_input_stream(name) as stream:
            manifest = json.loads(stream.read())
        files = manifest["files"] if manifest["replaces"] else files + manifest["files"]
    return files


class CellStore(DataSource):
    """Option ``path``; the schema is always that of a cell."""

    @classmethod
    def name(cls) -> str:
        return "cells"

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in COLUMNS)

    def reader(self, schema: StructType) -> CellReader:
        return CellReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> CellWriter:
        if sorted(schema.names) != sorted(COLUMNS) or {f.dataType.simpleString() for f in schema.fields} != {"string"}:
            raise ValueError(f"a cell has the text columns {', '.join(COLUMNS)}")
        return CellWriter(self.options["path"], overwrite)


@dataclass
class CellFile(InputPartition):
    name: str


class CellReader(DataSourceReader):
    """One part a file. Comparisons with ``family`` and ``row`` skip files by what their manifest says of them; in the files that are
    left they and those on the other columns skip row groups and rows."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        signs = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
        for one in filters:
            if isinstance(one, IsNotNull) and len(one.attribute) == 1:
                self.wanted.append((one.attribute[0], "known", None))
            elif type(one) in signs and len(one.attribute) == 1:
                self.wanted.append((one.attribute[0], signs[type(one)], one.value))
            else:
                yield one

    def _may_hold(self, file: dict) -> bool:
        for column, sign, value in self.wanted:
            low, high = (file["family"],) * 2 if column == "family" else (file["low"], file["high"]) if column == "row" else (None, None)
            if low is None or sign == "known":
                continue
            values = list(value) if sign == "in" else [value]
            fits = {
                "==": lambda v: low <= v <= high,
                "in": lambda v: low <= v <= high,
                ">": lambda v: high > v,
                ">=": lambda v: high >= v,
                "<": lambda v: low < v,
                "<=": lambda v: low <= v,
            }[sign]
            if not any(fits(v) for v in values):
                return False
        return True

    def partitions(self) -> list[CellFile]:
        # Spark wants one part at least
        return [CellFile(f["name"]) for f in listed(self.path) if self._may_hold(f)] or [CellFile("")]

    def read(self, partition: CellFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, root = opened(self.path)
        rule = None
        for column, sign, value in self.wanted:
            field_ = ds.field(column)
            one = {
                "==": lambda f, v: f == v,
                "in": lambda f, v: f.isin(list(v)),
                ">": lambda f, v: f > v,
                ">=": lambda f, v: f >= v,
                "<": lambda f, v: f < v,
                "<=": lambda f, v: f <= v,
                "known": lambda f, v: f.is_valid(),
            }[sign](field_, value)
            rule = one if rule is None else rule & one
        yield from ds.dataset(f"{root}/{partition.name}", filesystem=store, format="parquet").to_batches(columns=list(COLUMNS), filter=rule)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


class CellWriter(DataSourceArrowWriter):
    """A task writes files of its own, by family; what it wrote counts only when the commit names it.

    A task that fails takes its files away again, an aborted write those of all tasks that had finished. An attempt that dies with its executor leaves
    files that no manifest names and no reader sees.
    """

    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = opened(self.path)
        store.create_dir(f"{root}/data", recursive=True)
        writers: dict[str, pq.ParquetWriter] = {}
        done: list[dict] = []
        current: dict[str, dict] = {}
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch]).select(COLUMNS)
                if any(table.column(c).null_count for c in ("row", "family")):
                    raise ValueError("a cell without a row or a family")
                for family in pc.unique(table.column("family")).to_pylist():
                    part = table.filter(pc.equal(table.column("family"), family))
                    if family not in writers:
                        name = f"data/{uuid.uuid4().hex}.parquet"
                        current[family] = {"name": name, "family": family, "rows": 0, "low": None, "high": None}
                        done.append(current[family])
                        writers[family] = pq.ParquetWriter(f"{root}/{name}", part.schema, filesystem=store)
                    writers[family].write_table(part)
                    file, span = current[family], pc.min_max(part.column("row")).as_py()
                    file["rows"] += part.num_rows
                    file["low"] = span["min"] if file["low"] is None else min(file["low"], span["min"])
                    file["high"] = span["max"] if file["high"] is None else max(file["high"], span["max"])
                    if file["rows"] >= FILE_ROWS:
                        writers.pop(family).close()
            for writer in writers.values():
                writer.close()
        except BaseException:
            for writer in writers.values():
                writer.close()
            self._remove(done)
            raise
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        store.create_dir(f"{root}/manifests", recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        number = len(store.get_file_info(fs.FileSelector(f"{root}/manifests")))
        # written under another name first: a manifest is there as a whole or not at all
        name = f"{root}/manifests/{number:09d}-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{name}.part") as out:
            out.write(json.dumps({"replaces": self.overwrite, "files": files}).encode())
        store.move(f"{name}.part", f"{name}.json")

    def abort(self, messages: list[Written | None]) -> None:
        self._remove([f for m in messages if m is not None for f in m.files])

    def _remove(self, files: list[dict]) -> None:
        store, root = opened(self.path)
        for file in files:
            if store.get_file_info(f"{root}/{file['name']}").type != fs.FileType.NotFound:
                store.delete_file(f"{root}/{file['name']}")


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CellStore)
