"""Landed CSV files, read by contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tributary.contracts import Contract
from tributary.functions.payload import CORRUPT

# Taken for the text of rows that do not fit where the caller does not ask for it.
_TEXT = "__record"
_QUOTING = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


@dataclass(frozen=True)
class _Reading:
    """How a contract's files are read."""

    options: dict[str, str]
    schema: StructType
    text: str | None  # the column that takes the text of rows that do not fit
    asked_for: bool  # whether the caller wants that column
    filter_blank: bool

    def rows(self, reader, path: str | list[str]) -> DataFrame:
        rows = reader.options(**self.options).schema(self.schema).csv(path)
        if self.filter_blank:
            # Spark takes a line of blanks for a record here. Its first cell is asked for, too, as no query may use the text alone.
            first, text = F.trim(F.col(self.schema.names[0]).cast("string")), F.col(self.text)
            rows = rows.where(text.isNull() | text.rlike(r"[^\x00-\x20]") | (first != ""))
        return rows if self.asked_for or not self.text else rows.drop(self.text)


def _reading(spark: SparkSession, path: str | list[str], contract: Contract, corrupt: str | None) -> _Reading:
    options = {**_QUOTING, "multiLine": str(not contract.one_line).lower(), "enforceSchema": "false"}
    schema = contract.in_order_of(spark.read.options(**options).csv(path).columns)
    if contract.one_line and not corrupt:
        return _Reading(options, schema, None, False, False)
    text = corrupt or _TEXT
    # Whether a row has too many or too few cells is not to depend on which of them are asked for.
    options |= {"columnNameOfCorruptRecord": text, "columnPruning": "false"}
    schema = StructType([*schema.fields, StructField(text, StringType())])
    return _Reading(options, schema, text, bool(corrupt), not contract.one_line)


def read_landed(
    spark: SparkSession, path: str | list[str], contract: Contract, *, corrupt: str | None = CORRUPT
) -> DataFrame:
    """CSV with a header, its columns found by name and typed by the contract.

    Nothing is inferred, so one odd cell cannot change a column's type. A row
    that does not fit (a bad number, too few or too many cells) is kept with
    what could be read, and its text stands in the ``corrupt`` column. Every
    file has to have the same header.

    Quoted cells may hold line breaks, and a file is then read by one task: land many files, not one. Where the
    contract says that a record is one line, files of any size are read in splits. Lines of
    blanks only are no records.
    """
    return _reading(spark, path, contract, corrupt).rows(spark.read, path)


def stream_landed(spark: SparkSession, path: str, contract: Contract, *, corrupt: str | None = CORRUPT) -> DataFrame:
    """The same rows as a stream over the files as they land. One file has to be there, for its header."""
    return _reading(spark, path, contract, corrupt).rows(spark.readStream, path)


def landed_state(spark: SparkSession, path: str | list[str]) -> str:
    """A digest of which files have landed, by names, sizes and times; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    state = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("all")).first()
    return f"{state['n']} files {state['all']}"
