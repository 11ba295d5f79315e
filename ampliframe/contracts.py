"""Argument and column checks that run before any plan is built."""

from __future__ import annotations

import math
from collections.abc import Iterable
from numbers import Real

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    present = set(df.columns)
    missing = [c for c in dict.fromkeys(columns) if c not in present]
    if missing:
        raise ValueError(f"{what} is missing required column(s): {', '.join(missing)}")


class ProblemRows(ValueError):
    """Rows that a check refuses. `problems` is the whole table of them, to show or to write."""

    def __init__(self, message: str, problems: DataFrame):
        super().__init__(message)
        self.problems = problems


def refuse_rows(problems: DataFrame, what: str, shown: Column | str) -> None:
    """Raise `ProblemRows` if there is any row; the message tells how many and the first.

    All of them are counted; only one text reaches the driver.
    """
    told = F.col(shown) if isinstance(shown, str) else shown
    seen = problems.agg(F.count(F.lit(1)).alias("n"), F.min(told).alias("first")).first()
    if seen["n"]:
        raise ProblemRows(
            f"{what}: {seen['n']} row(s), the first is {seen['first']}; "
            "the error's `problems` table holds all of them",
            problems,
        )


def text_argument(value: object, name: str) -> str:
    if not isinstance(value, str) or value == "":
        raise ValueError(f"{name} must be one non-empty string")
    return value


def flag_argument(value: object, name: str) -> bool:
    if not isinstance(value, bool):
        raise ValueError(f"{name} must be True or False")
    return value


def number_argument(value: object, name: str, minimum: float | None = None) -> float:
    if isinstance(value, bool) or not isinstance(value, Real) or not math.isfinite(value):
        raise ValueError(f"{name} must be one finite number")
    if minimum is not None and value < minimum:
        raise ValueError(f"{name} must be at least {minimum}")
    return value


def integer_argument(value: object, name: str, minimum: int = 0) -> int:
    number_argument(value, name, minimum)
    if value != int(value):
        raise ValueError(f"{name} must be a whole number")
    return int(value)
