"""Tables to JSON messages and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.functions.payload import CORRUPT, decode_payload, encode_row


def encode_rows(df: DataFrame, *columns: str) -> DataFrame:
    """One JSON object per row in a single column ``value``."""
    return df.select(encode_row(*columns))


def decode_rows(
    messages: DataFrame,
    schema: StructType,
    *,
    value: str = "value",
    corrupt: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The schema's fields as columns, one row per message, none dropped.

    With ``corrupt`` (``"_corrupt_record"`` by convention) a column of that name
    holds the payload of each message that did not parse in full. ``keep`` names
    message columns to carry along.
    """
    data = decode_payload(value, schema, corrupt)
    return messages.select(*keep, data.alias("data")).select(*keep, "data.*")


def undecodable(corrupt: str = CORRUPT, *required: str):
    """True for a decoded row that is of no use: malformed, or without a key.

    A null payload, ``{}`` and a missing key leave the corrupt column empty, so
    the key has to be looked at as well.
    """
    bad = F.col(corrupt).isNotNull()
    for name in required:
        bad = bad | F.col(name).isNull()
    return bad
