"""CSV members of zip and tar archives as rows.

Spark lists and reads the archives (``binaryFile``, so any file system will do), one
row each, up to its limit of 2 GB; tasks unpack them member by member and parse what
they unpack in blocks, so that beside the packed archive only a block is in memory.
Columns that are not asked for are never built. Archives are spread over tasks by a
hash of their paths, since a few large ones may stand together.

Members that are not CSV (by ``pattern``) are passed over. A member that cannot be
unpacked to its end (checksum, cut off) fails the query, or is left out as a whole with
``broken="skip"``. Lines with another number of fields than the header are left out.
Rar archives need a program that is not part of Python; repack them.
"""

from __future__ import annotations

import bz2
import fnmatch
import gzip
import io
import lzma
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are parsed at once, and rows of a batch to the JVM.
BLOCK, BATCH = 4 << 20, 10_000
_ERRORS = (zipfile.BadZipFile, tarfile.TarError, zlib.error, gzip.BadGzipFile, lzma.LZMAError, EOFError, OSError, NotImplementedError)


def files(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """(path, content) of the archives under the paths, found recursively."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(paths if isinstance(paths, str) else list(paths)).select("path", "content")


def _members(content: bytes) -> Iterator[tuple[str, Callable[[], io.BufferedIOBase]]]:
    """Names of the members with functions that open them."""
    raw = io.BytesIO(content)
    if zipfile.is_zipfile(raw):
        archive = zipfile.ZipFile(raw)
        for info in archive.infolist():
            if not info.is_dir():
                yield info.filename, lambda info=info: archive.open(info)
        return
    raw.seek(0)
    archive = tarfile.open(fileobj=raw, mode="r:*")
    for member in archive:
        if member.isfile():
            yield member.name, lambda member=member: archive.extractfile(member)


def _whole(opened: io.BufferedIOBase) -> None:
    """Unpacks to the end, block by block, to see whether it can be."""
    with opened:
        while opened.read(BLOCK):
            pass


def _parsed(opened: io.BufferedIOBase, header: Sequence[str], wanted: Sequence[str]) -> Iterator[pa.RecordBatch]:
    read = csv.ReadOptions(column_names=list(header), skip_rows=1, block_size=BLOCK, use_threads=False)
    parse = csv.ParseOptions(newlines_in_values=True, invalid_row_handler=lambda _: "skip")
    convert = csv.ConvertOptions(include_columns=list(wanted), column_types=dict.fromkeys(header, pa.string()), strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=False)
    with opened:
        try:
            yield from csv.open_csv(opened, read, parse, convert)
        except pa.ArrowInvalid as e:
            if "Empty CSV" not in str(e):
                raise


def unpacked(archives: DataFrame, header: Sequence[str], columns: Sequence[str] | None = None, pattern: str = "*.csv", broken: str = "fail") -> DataFrame:
    """(archive, member, columns as text) of the CSV members of ``archives`` (path, content)."""
    if broken not in ("fail", "skip"):
        raise ValueError("broken: fail or skip")
    wanted = list(columns or header)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    members = [(n, o) for n, o in _members(content.as_py()) if fnmatch.fnmatch(n, pattern)]
                except _ERRORS:
                    if broken == "fail":
                        raise
                    continue
                for name, opened in members:
                    try:
                        _whole(opened())
                    except _ERRORS:
                        if broken == "fail":
                            raise
                        continue
                    for rows in _parsed(opened(), header, wanted):
                        for at in range(0, rows.num_rows, BATCH):
                            part = rows.slice(at, BATCH)
                            ends = [pa.array([x] * part.num_rows, pa.string()) for x in (path, name)]
                            yield pa.RecordBatch.from_arrays([*ends, *part.columns], names=["archive", "member", *wanted])

    dealt = archives.select("path", "content").repartition(F.xxhash64("path"))
    quoted = ", ".join(f"`{c}` string" for c in wanted)
    return dealt.mapInArrow(run, f"archive string, member string, {quoted}")
