"""Payload bytes: files on disk, archives and CSV tables."""

from __future__ import annotations

import csv
import io
import lzma
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.operators.typed import infer_columns

#: A member is handed on in parts of this size, so none has to fit in memory.
PART_BYTES = 16 * 2**20
#: Bytes of small members that are handed on together.
_BATCH_BYTES = 2**20
#: Rows and characters of a decoded table handed to the JVM at a time.
_CSV_BATCH = 2000
_CSV_BATCH_CHARS = 16 * 2**20

#: What reading a damaged, encrypted or otherwise unreadable archive raises.
UNREADABLE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, OSError, NotImplementedError, RuntimeError, ValueError)

# A cell may be as long as its file.
csv.field_size_limit(2**31 - 1)

#: Key of a record under which the cells beyond the header are kept, as CSV.
EXTRA = "_extra"


def scan_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(path, modificationTime, length, content)`` of payload files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def expand_archive(
    payloads: DataFrame, suffix: str | None = None, key: str = "storage_key", part_bytes: int = PART_BYTES
) -> DataFrame:
    """``(key, member_no, member, part_no, data, error_text)`` for zip payloads.

    ``suffix`` keeps members by name, case-sensitively; without it all are kept.
    Member names are data, never paths. A corrupt archive gives an error row
    after the parts that could be read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict[str, object]] = []
        held = 0
        for batch in batches:
            for payload_key, content in zip(batch[key], batch["content"]):
                for row in _members(payload_key.as_py(), content.as_py()):
                    size = len(row.get("data") or b"") + 100
                    if rows and held + size > min(part_bytes, _BATCH_BYTES):
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                    rows.append(row)
                    held += size
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _members(payload_key: str, content: bytes) -> Iterator[dict[str, object]]:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for number, info in enumerate(archive.infolist()):
                    if info.is_dir() or (suffix is not None and not info.filename.endswith(suffix)):
                        continue
                    with archive.open(info) as stream:
                        part = 0
                        while (data := stream.read(part_bytes)) or part == 0:
                            yield {
                                key: payload_key,
                                "member_no": number,
                                "member": info.filename,
                                "part_no": part,
                                "data": data,
                            }
                            part += 1
        except UNREADABLE as error:  # a corrupt archive is an outcome, not a failed job
            yield {key: payload_key, "error_text": f"{type(error).__name__}: {error}"}

    schema = pa.schema(
        [
            (key, pa.string()),
            ("member_no", pa.int32()),
            ("member", pa.string()),
            ("part_no", pa.int32()),
            ("data", pa.binary()),
            ("error_text", pa.string()),
        ]
    )
    ddl = f"{key} string, member_no int, member string, part_no int, data binary, error_text string"
    return payloads.select(F.col(key).cast("string"), "content").mapInArrow(run, ddl)


def _unique_names(header: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    names = []
    for name in header:
        repeats = seen.get(name)
        seen[name] = 0 if repeats is None else repeats + 1
        names.append(name if repeats is None else f"{name}_duplicated_{repeats}")
    return names


def decode_csv(payloads: DataFrame, key: str = "dataset_id") -> DataFrame:
    """``(dataset_id, row_idx, record)`` for CSV payloads ``(key, content)``.

    Each payload is read once, where it is. Every cell stays as it was written;
    :func:`~gleanspark.operators.typed.infer_columns` tells the types that all
    rows allow. Empty cells are null, short rows are padded with null, and what a
    row has beyond the header is kept under ``_extra``.
    """

    def tables(content: bytes) -> Iterator[tuple[str | None, BinaryIO]]:
        yield None, io.BytesIO(content)

    return _decode(payloads, key, tables).drop("member", "error_text")


def decode_archives(payloads: DataFrame, suffix: str | None = ".csv", key: str = "dataset_id") -> DataFrame:
    """``(dataset_id, member, row_idx, record, error_text)`` for the CSV members of zip payloads.

    As :func:`decode_csv`; members are decoded as they are unpacked, whatever
    their size. A broken archive gives the rows read so far, and then one row
    with the member it broke in and ``error_text``, without index and record.
    """

    def tables(content: bytes) -> Iterator[tuple[str | None, BinaryIO]]:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for info in archive.infolist():
                if not info.is_dir() and (suffix is None or info.filename.endswith(suffix)):
                    with archive.open(info) as stream:
                        yield info.filename, stream

    return _decode(payloads, key, tables)


def _decode(payloads: DataFrame, key: str, tables: Callable) -> DataFrame:
    def rows_of(payload_key: str, content: bytes) -> Iterator[tuple]:
        member = None
        try:
            for member, stream in tables(content):
                names, rows = _cells(stream)
                for index, cells in enumerate(rows):
                    extra = cells[len(names)]
                    yield payload_key, member, index, names + [EXTRA] if extra else names, cells if extra else cells[:-1], None
        except UNREADABLE as error:
            yield payload_key, member, None, [], [], f"{type(error).__name__}: {error}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Rows()
        for batch in batches:
            for payload_key, content in zip(batch["dataset_id"], batch["content"]):
                for row in rows_of(payload_key.as_py(), content.as_py()):
                    held.add(*row)
                    if len(held.ids) >= _CSV_BATCH or held.chars >= _CSV_BATCH_CHARS:
                        yield held.flush()
        if held.ids:
            yield held.flush()

    return payloads.select(F.col(key).cast("string").alias("dataset_id"), "content").mapInArrow(
        run, "dataset_id string, member string, row_idx bigint, record map<string,string>, error_text string"
    )


def check_archives(payloads: DataFrame, key: str = "storage_key") -> DataFrame:
    """``(key, error_text)`` for zip payloads that cannot be read to their end; no bytes are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {key: payload_key.as_py(), "error_text": problem}
                for payload_key, content in zip(batch[key], batch["content"])
                if (problem := _problem(content.as_py())) is not None
            ]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(key, pa.string()), ("error_text", pa.string())]))

    return payloads.select(F.col(key).cast("string"), "content").mapInArrow(run, f"{key} string, error_text string")


def _problem(content: bytes) -> str | None:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            damaged = archive.testzip()
    except UNREADABLE as error:
        return f"{type(error).__name__}: {error}"
    return None if damaged is None else f"BadZipFile: damaged member {damaged}"


def _cells(stream: BinaryIO) -> tuple[list[str], Iterator[list[str | None]]]:
    """Header and rows of one CSV stream; a row is as wide as the header and one, what is beyond being last."""
    text = io.TextIOWrapper(stream, "utf-8-sig", "replace", newline="")
    lines = (line for line in csv.reader(text) if line)
    names = _unique_names(next(lines, []))
    width = len(names)
    return names, ([c or None for c in (cells + [""] * width)[:width]] + [_as_csv(cells[width:])] for cells in lines)


def _as_csv(cells: list[str]) -> str | None:
    if not cells:
        return None
    written = io.StringIO()
    csv.writer(written, lineterminator="").writerow(cells)
    return written.getvalue()


class _Rows:
    """Decoded rows on their way to one Arrow batch."""

    def __init__(self) -> None:
        self.ids: list[str] = []
        self.members: list[str | None] = []
        self.index: list[int] = []
        self.ends: list[int] = [0]
        self.names: list[str] = []
        self.cells: list[str | None] = []
        self.errors: list[str | None] = []
        self.chars = 0

    def add(
        self, dataset_id: str, member: str | None, index: int | None, names: list[str], cells: list[str | None], error: str | None
    ) -> None:
        self.ids.append(dataset_id)
        self.members.append(member)
        self.index.append(index)
        self.names += names
        self.cells += cells
        self.ends.append(len(self.cells))
        self.errors.append(error)
        self.chars += sum(len(c) for c in cells if c)

    def flush(self) -> pa.RecordBatch:
        records = pa.MapArray.from_arrays(
            pa.array(self.ends, pa.int32()), pa.array(self.names, pa.string()), pa.array(self.cells, pa.string())
        )
        texts = [pa.array(values, pa.string()) for values in (self.ids, self.members)]
        columns = [*texts, pa.array(self.index, pa.int64()), records, pa.array(self.errors, pa.string())]
        self.__init__()
        return pa.RecordBatch.from_arrays(columns, ["dataset_id", "member", "row_idx", "record", "error_text"])


def read_csv_table(spark: SparkSession, path: str) -> DataFrame:
    """One large CSV file or folder, split by Spark; each column has the type that all its cells allow."""
    text = spark.read.option("header", True).csv(path)
    names = text.columns
    records = text.select(
        F.lit(0).alias("dataset_id"), F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"`{n}`"))]).alias("record")
    )
    found = infer_columns(records).collect()
    types = found[0]["columns"] if found else {}
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(types.get(n, "string"))) for n in names])
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
