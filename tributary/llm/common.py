"""What the operators of this package share: words, keys of rows, scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.scratch import scratch_path
from tributary.workers import mapped  # noqa: F401  (the operators take it from here)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Over UTF-8 bytes: what is no digit, letter or beyond ASCII becomes a blank, A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a scratch table in the shared folder and read back: a cut of the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_VALUES = 2_000_000


def joinable(df: DataFrame, array: str | None = None) -> DataFrame:
    """A stored table of ids, and perhaps an array of numbers, with the hint to broadcast it if it is small enough.

    Rows and numbers are counted first: up to ``BROADCAST_VALUES`` the other side stays where it is.
    """
    numbers = F.sum(F.size(array)) if array else F.lit(0)
    n = df.agg((F.count(F.lit(1)) + F.coalesce(numbers, F.lit(0))).alias("n")).first()["n"]
    return F.broadcast(df) if n <= BROADCAST_VALUES else df


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A stored table of a few bytes a row, with the hint to broadcast it if it has few enough of them."""
    return F.broadcast(df) if df.count() <= rows else df


def unused(df: DataFrame, name: str) -> str:
    """The name, made longer until no column of the table has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_lines(text: Column, places: Column) -> Column:
    """The text without its lines at these places, in time linear in the lines."""
    lines = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
    return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")


def words_at(text: Column, places: Column) -> Column:
    """The number of words in the lines at these places."""
    lines = F.split(text, "\n")
    # Blanks as the contracts have them; a text of blanks only has no words.
    return F.size(F.regexp_extract_all(F.array_join(F.transform(places, lambda i: F.get(lines, i)), " "), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))


def node_key(least: Column, digest: Column) -> Column:
    """The key of a node of a graph: the smallest id of its rows, then a digest of what they have in common.

    Keys compare as ids do, a null id last, so that the smallest node of a component tells the smallest id in it.
    """
    ordered = F.lpad(F.hex(least.bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(F.unhex(F.coalesce(F.concat(F.lit("00"), ordered), F.lit("FF" * 9))), digest)


def id_of(key: Column) -> Column:
    """The id a ``node_key`` starts with."""
    ordered = F.conv(F.hex(F.substring(key, 2, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(2**63)))
    return F.when(F.hex(F.substring(key, 1, 1)) == "00", ordered)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """Tells rows of one id but different texts apart; null has a key of its own."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
