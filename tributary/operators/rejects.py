"""Rows that a target would refuse, set aside with the reasons instead of lost."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.contracts import Contract
from tributary.functions.numbers import is_castable

REASONS = "reject_reasons"


@dataclass(frozen=True)
class Rule:
    """A named condition that a valid row meets; null counts as not met.

    The condition is built when the rule is used, so that rules can be written
    down before there is a session.
    """

    name: str
    condition: Callable[[], Column]

    @property
    def holds(self) -> Column:
        return F.coalesce(self.condition(), F.lit(False))


def rule_not_null(column: str) -> Rule:
    return Rule(f"{column}_missing", lambda: F.col(column).isNotNull())


def rule_castable(column: str, to: str = "float", missing: bool = False) -> Rule:
    """The text reads as this type; with ``missing``, or there is none."""
    return Rule(f"{column}_not_{to}", lambda: is_castable(column, to) | (F.lit(missing) & F.col(column).isNull()))


def rule_max_length(column: str, characters: int) -> Rule:
    """The length limit a database column sets; a missing text is not too long."""
    return Rule(
        f"{column}_too_long",
        lambda: F.col(column).isNull() | (F.char_length(column) <= characters),
    )


def contract_rules(contract: Contract) -> list[Rule]:
    """What a contract asks of a row: its required columns are there, its texts read as what they should and are no longer than they may."""
    return [
        *(rule_not_null(column) for column in contract.required),
        *(rule_castable(column, to, missing=True) for column, to in contract.castable.items()),
        *(rule_max_length(column, characters) for column, characters in contract.longest.items()),
    ]


def tag_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of the rules each row breaks; an empty array marks a valid row."""
    nothing = F.array(F.lit(None).cast("string"))
    names = [F.when(~rule.holds, F.lit(rule.name)) for rule in rules]
    return df.withColumn(REASONS, F.array_except(F.array(*names) if names else nothing, nothing))


def is_valid(rules: Sequence[Rule]) -> Column:
    """True for a row that meets every rule; never null."""
    return reduce(lambda left, right: left & right, (rule.holds for rule in rules), F.lit(True))


def split_rejects(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and the rest with their reasons; together they are the input."""
    valid = is_valid(rules)
    return df.filter(valid), tag_rejects(df.filter(~valid), rules)

