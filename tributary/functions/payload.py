"""One JSON object per message: how rows go onto a topic and come off it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def encode_row(*columns: str) -> Column:
    """The named columns, or the whole row, as one JSON text named ``value``.

    A null field is left out, NaN becomes the text ``"NaN"``.
    """
    return F.to_json(F.struct(*(columns or ("*",)))).alias("value")


def decode_payload(value: Column | str, schema: StructType, corrupt: str | None = None) -> Column:
    """A binary or text payload as a struct of the schema's fields.

    Malformed text gives nulls throughout, a field of the wrong type a null in
    that field. With ``corrupt`` the struct also has a field of that name that
    holds the payload in both cases.
    """
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    if corrupt is None:
        return F.from_json(text, schema)
    kept = StructType([*schema.fields, StructField(corrupt, StringType())])
    return F.from_json(text, kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
