"""A registered query: how to build it, its output shape, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPARK = {"l": "bigint", "s": "string", "d": "double", "b": "boolean"}
_DUCK = {"l": "BIGINT", "s": "VARCHAR", "d": "DOUBLE", "b": "BOOLEAN"}


@dataclass(frozen=True)
class Query:
    """``shape`` is ``"name:kind ..."`` with kind l(ong), s(tring), b(ool) or dN (double, N places)."""

    build: Callable[[SparkSession, str], DataFrame]
    shape: str
    sql: str | None = None

    def columns(self) -> list[tuple[str, str]]:
        return [tuple(part.split(":")) for part in self.shape.split()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        out = []
        for name, kind in self.columns():
            value = F.col(name).cast(_SPARK[kind[0]])
            if kind[0] == "d":
                value = F.round(value, int(kind[1:])) + F.lit(0.0)
            out.append(value.alias(name))
        return df.select(*out)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        out = []
        for name, kind in self.columns():
            value = f"CAST({name} AS {_DUCK[kind[0]]})"
            if kind[0] == "d":
                value = f"round({value}, {int(kind[1:])}) + CAST(0 AS DOUBLE)"
            out.append(f"{value} AS {name}")
        return f"SELECT {', '.join(out)} FROM ({self.sql}) AS result_rows"
