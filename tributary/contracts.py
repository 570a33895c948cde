"""Column contracts: what a table must look like, declared instead of inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


class ContractError(ValueError):
    """A table does not have the columns or the types its contract names."""


def without_fields(schema: StructType, *names: str) -> StructType:
    """The schema less the named fields; names it does not have are ignored."""
    return StructType([field for field in schema.fields if field.name not in names])


@dataclass(frozen=True)
class Contract:
    """A named schema, and what a row has to meet to be of use.

    A file has to have the required columns; ``contract_rules`` refuses rows that have a null in one. It also refuses rows
    with a text that does not read as the type ``castable`` gives its column, or with more characters than ``longest`` allows; a missing text does neither.
    ``one_line`` says that no cell of a landed file holds a line break, so that large files can be split.
    """

    name: str
    schema: StructType
    required: tuple[str, ...] = ()
    one_line: bool = False
    castable: Mapping[str, str] = field(default_factory=dict, hash=False)
    longest: Mapping[str, int] = field(default_factory=dict, hash=False)

    @property
    def ddl(self) -> str:
        """The schema as a DDL string, the form ``customSchema`` takes."""
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields)

    def without(self, *names: str) -> Contract:
        required = tuple(name for name in self.required if name not in names)
        castable, longest = ({k: v for k, v in rules.items() if k not in names} for rules in (self.castable, self.longest))
        return replace(self, schema=without_fields(self.schema, *names), required=required, castable=castable, longest=longest)

    def ruled(
        self, required: Sequence[str] = (), castable: Mapping[str, str] | None = None, longest: Mapping[str, int] | None = None
    ) -> Contract:
        """The contract with these rules in addition, or ``ContractError`` when they name a column it does not have."""
        castable, longest = castable or {}, longest or {}
        unknown = [name for name in (*required, *castable, *longest) if name not in self.schema.names]
        if unknown:
            raise ContractError(f"{self.name}: rules for unknown columns {unknown}")
        required = tuple(dict.fromkeys((*self.required, *required)))
        return replace(self, required=required, castable={**self.castable, **castable}, longest={**self.longest, **longest})

    def in_order_of(self, header: list[str]) -> StructType:
        """The contract's columns in a file's own order, found by name in any case.

        A column the contract does not know stays text. A column it requires
        must be there; any other may be missing.
        """
        known = {field.name.lower(): field for field in self.schema.fields}
        found = [known.get(name.lower(), StructField(name, StringType())) for name in header]
        missing = [name for name in self.required if name not in (field.name for field in found)]
        if missing:
            raise ContractError(f"{self.name}: missing required columns {missing}")
        return StructType(found)

    def conform(self, df: DataFrame) -> DataFrame:
        """Exactly the contract's columns, or ``ContractError`` when they are not there."""
        actual = {field.name: field.dataType for field in df.schema.fields}
        problems = [
            f"{f.name}: {actual.get(f.name, 'absent')} instead of {f.dataType}"
            for f in self.schema.fields
            if actual.get(f.name) != f.dataType
        ]
        if problems:
            raise ContractError(f"{self.name}: " + "; ".join(problems))
        return df.select(*self.schema.names)


# Names, order and types of the columns of the three tables.
ATHLETE_BIO = Contract(
    "athlete_bio",
    StructType(
        [
            StructField("athlete_id", IntegerType()),
            StructField("name", StringType()),
            StructField("sex", StringType()),
            StructField("born", StringType()),
            StructField("height", StringType()),
            StructField("weight", StringType()),
            StructField("country", StringType()),
            StructField("country_noc", StringType()),
            StructField("description", StringType()),
            StructField("special_notes", StringType()),
        ]
    ),
    required=("athlete_id",),
)

ATHLETE_EVENT_RESULTS = Contract(
    "athlete_event_results",
    StructType(
        [
            StructField("edition", StringType()),
            StructField("edition_id", IntegerType()),
            StructField("country_noc", StringType()),
            StructField("sport", StringType()),
            StructField("event", StringType()),
            StructField("result_id", LongType()),
            StructField("athlete", StringType()),
            StructField("athlete_id", IntegerType()),
            StructField("pos", StringType()),
            StructField("medal", StringType()),
            StructField("isTeamSport", StringType()),
        ]
    ),
    required=("athlete_id",),
)

AVERAGE_STATS = Contract(
    "avg_stats",
    StructType(
        [
            StructField("sport", StringType()),
            StructField("medal", StringType()),
            StructField("sex", StringType()),
            StructField("country_noc", StringType()),
            StructField("avg_height", DoubleType()),
            StructField("avg_weight", DoubleType()),
            StructField("timestamp", TimestampType()),
        ]
    ),
)
