"""Scans: Parquet by name, glob or merged schema; typed, sniffed and zipped CSV; JSON."""

from __future__ import annotations

import codecs
import csv
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; a file and a directory of files read alike."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parquet_glob(spark: SparkSession, pattern: str, merge: bool = False) -> DataFrame:
    """All files of a glob. With merge, columns are united by name and absent ones are null."""
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(pattern)


#: Types in the order in which one holds the one before; a type outside the list meets others only in string.
_WIDER = ["boolean", "tinyint", "smallint", "int", "bigint", "double", "string"]


def common_type(a: str, b: str) -> str:
    """The least type that holds both: the wider of two numbers, the same for equal types, timestamp for a date and a timestamp, else string."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    if {a, b} <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp"
    numbers = _WIDER[1:-1]
    if {a, b} <= {*numbers, "float"}:
        rank = lambda t: numbers.index("double" if t == "float" else t)
        return numbers[max(rank(a), rank(b))]
    return "string"


def union_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files or globs united by column name; absent columns are null, columns of several types take their common one.

    Schemas are read from the footers of one file per path. Columns keep the order in which they are first met.
    """
    frames = [spark.read.parquet(p) for p in paths]
    types: dict[str, str] = {}
    for df in frames:
        for c, t in df.dtypes:
            types[c] = common_type(types.get(c, "void"), t)
    as_one = [df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]) for df in frames]
    return reduce(DataFrame.unionByName, as_one)


def csv_text(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A CSV with a header, every column text: codes keep their leading zeros."""
    return spark.read.option("header", True).option("sep", sep).option("encoding", encoding).csv(path)


def csv_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV seed with declared types; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose types come from all of its rows; for profiling only."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def sniff_separator(spark: SparkSession, path: str, candidates: Sequence[str] = (";", ",", "\t", "|")) -> str:
    """The candidate that occurs most in the first line; ties go to the earlier candidate."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    return max(candidates, key=lambda c: (line.count(c), -candidates.index(c)))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per CSV member of an archive: its compressed bytes as they stand, nothing unpacked yet."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for info in sorted(z.infolist(), key=lambda m: m.filename):
                    if not info.filename.lower().endswith(".csv"):
                        continue
                    # The local header's name and extra field may be as long as they like.
                    at = info.header_offset + 30 + sum(struct.unpack("<HH", content[info.header_offset + 26 : info.header_offset + 30]))
                    row = [[path], [info.filename], [info.compress_type], [content[at : at + info.compress_size]]]
                    kinds = (pa.string(), pa.string(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=["archivo", "miembro", "method", "raw"])


def _unpacked(method: int, raw: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    if method == zipfile.ZIP_STORED:
        yield raw
        return
    if method != zipfile.ZIP_DEFLATED:
        raise ValueError(f"compression method {method} of a ZIP member is not known")
    inflate = zlib.decompressobj(-15)
    for i in range(0, len(raw), step):
        part = inflate.decompress(raw[i : i + step], step)
        while part:
            yield part
            part = inflate.decompress(inflate.unconsumed_tail, step) if inflate.unconsumed_tail else b""
    yield inflate.flush()


def _lines(parts: Iterator[bytes]) -> Iterator[str]:
    """Text lines of a stream of bytes; line ends are kept for the CSV reader."""
    decoder = codecs.getincrementaldecoder("utf-8-sig")()
    rest = ""
    for part in parts:
        rest += decoder.decode(part)
        lines = re.split(r"(?<=\n)|(?<=\r)(?!\n)", rest)
        # The last line may go on.
        rest = lines.pop()
        yield from lines
    if rest:
        yield rest


def _rows_of(columns: Sequence[str]):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, member, method, raw in zip(*(pdf[c] for c in ("archivo", "miembro", "method", "raw"))):
                block: list[list[str | None]] = []
                for record in csv.DictReader(_lines(_unpacked(int(method), raw))):
                    block.append([path, member, *[record.get(c) for c in columns]])
                    if len(block) == 10_000:
                        yield pd.DataFrame(block, columns=["archivo", "miembro", *columns])
                        block = []
                if block:
                    yield pd.DataFrame(block, columns=["archivo", "miembro", *columns])

    return rows


def zip_of_csvs(spark: SparkSession, pattern: str, columns: Sequence[str]) -> DataFrame:
    """The CSV members of ZIP files as text columns plus archivo and miembro, one task per member.

    An archive is opened by one task, which sends its members on as they are compressed; each is unpacked and parsed as a stream. Only the
    listed columns are read; one that a member lacks is null there.
    """
    schema = ", ".join(f"`{c}` string" for c in ["archivo", "miembro", *columns])
    files = spark.read.format("binaryFile").load(pattern).select("path", "content")
    members = files.mapInArrow(_members, "archivo string, miembro string, method int, raw binary").repartition("archivo", "miembro")
    return members.mapInPandas(_rows_of(list(columns)), schema)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared schema; lines that do not parse are null rows."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def probe(df: DataFrame, expected: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Keep the expected columns, null where absent; fail if a required one is missing. Reads no rows."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in expected])
