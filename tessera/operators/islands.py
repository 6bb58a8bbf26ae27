"""A table function whose result columns follow from its arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from tessera.shipping import ship


class Islands:
    """Runs of an equal value among rows in order: the value, the first and last place, and the number of rows.

    SQL: SELECT * FROM islands(TABLE(t) PARTITION BY (k) ORDER BY (at), 'value', 'at').
    analyze() takes the types of the two named columns from the table given,
    so the function serves any table; rows come as a stream and a run is all
    that is held. Nulls are equal to each other. The partition's columns are
    added by by_run().
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, value: AnalyzeArgument, at: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable:
            raise ValueError("islands needs a TABLE argument")
        fields = {f.name.lower(): f for f in table.dataType.fields}
        for name in (value.value, at.value):
            if not isinstance(name, str) or name.lower() not in fields:
                raise ValueError(f"no column {name!r} in the table; it has {', '.join(sorted(fields))}")
        v, a = (fields[name.lower()].dataType for name in (value.value, at.value))
        keys = [StructField(f.name, f.dataType) for f in table.dataType.fields if f.name.lower() not in (value.value.lower(), at.value.lower())]
        return AnalyzeResult(StructType([*keys, StructField("value", v), StructField("first_at", a), StructField("last_at", a), StructField("n", LongType())]))

    def __init__(self):
        self.run = None

    def eval(self, table: Row, value: str, at: str):
        names = {n.lower(): n for n in table.asDict()}
        v, a = table[names[value.lower()]], table[names[at.lower()]]
        if self.run and self.run[1] == v:
            self.run[3] = a
            self.run[4] += 1
            return
        if self.run:
            yield (*self.run[0], *self.run[1:])
        others = tuple(table[n] for low, n in names.items() if low not in (value.lower(), at.lower()))
        self.run = [others, v, a, a, 1]

    def terminate(self):
        if self.run:
            yield (*self.run[0], *self.run[1:])


def register(spark: SparkSession) -> None:
    """Make islands known to SQL."""
    ship(spark)
    spark.udtf.register("islands", udtf(Islands))


def islands(df: DataFrame, keys: list[str], value: str, at: str) -> DataFrame:
    """keys, value, first_at, last_at and n of each run of a value within a key, in the order of `at`; rows that tie on it should be told apart by it."""
    spark = df.sparkSession
    register(spark)
    rows = df.select(*keys, value, at)
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    part = ", ".join(map(quoted, keys))
    return spark.sql(f"SELECT {', '.join(map(quoted, keys))}, value, first_at, last_at, n FROM islands(TABLE(SELECT * FROM {{rows}}) PARTITION BY ({part}) ORDER BY ({quoted(at)}), '{value}', '{at}')", rows=rows)
