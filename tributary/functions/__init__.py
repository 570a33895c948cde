"""Column expressions; every one of them stays inside Spark's generated code."""

from tributary.functions.numbers import addends, is_castable, mean_of, measure
from tributary.functions.payload import decode_payload, encode_row
from tributary.functions.text import normalized

__all__ = [
    "decode_payload",
    "encode_row",
    "addends",
    "is_castable",
    "mean_of",
    "measure",
    "normalized",
]
