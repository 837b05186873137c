from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rules: list[tuple[str | Column, Column]], otherwise: str | Column | None) -> Column:
    """The label of the first condition that holds. A condition that is NULL does not hold."""
    label, condition = rules[0]
    chain = F.when(condition, label)
    for label, condition in rules[1:]:
        chain = chain.when(condition, label)
    return chain.otherwise(otherwise) if otherwise is not None else chain


def mapped(value: Column, labels: dict[str, str], otherwise: str | Column) -> Column:
    """Value map with a default."""
    return ladder([(label, value == key) for key, label in labels.items()], otherwise)


def rolled_up(value: Column, groups: dict[str, list[str]], otherwise: str) -> Column:
    return ladder([(name, value.isin(members)) for name, members in groups.items()], otherwise)


def part(text: Column, n: int, mark: str = "_") -> Column:
    """The n-th piece of a delimited text, '' behind its end."""
    return F.split_part(text, F.lit(mark), F.lit(n))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
