"""Finding and quoting column names the way Spark resolves them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Prefix of helper columns; sources must not use it.
RESERVED_PREFIX = "__"


def quoted(name: str) -> str:
    """``name`` as a back-quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The top-level column called exactly ``name`` (dots and spaces allowed)."""
    return F.col(quoted(name))


def _fold(spark: SparkSession):
    sensitive = spark.conf.get("spark.sql.caseSensitive").lower() == "true"
    return (lambda name: name) if sensitive else str.lower


class Names:
    """Looks names up in a DataFrame's columns; build once for many lookups."""

    def __init__(self, df: DataFrame) -> None:
        self._fold = _fold(df.sparkSession)
        self._spelled: dict[str, str] = {}
        for name in df.columns:
            self._spelled.setdefault(self._fold(name), name)

    def find(self, name: str) -> str | None:
        """The column Spark would resolve ``name`` to, as spelled in the data."""
        return self._spelled.get(self._fold(name))


def find(df: DataFrame, name: str) -> str | None:
    return Names(df).find(name)


def require(df: DataFrame, names: Iterable[str], what: str) -> list[str]:
    """Resolve every name, or fail before any job is started."""
    lookup = Names(df)
    found = {name: lookup.find(name) for name in names}
    missing = [name for name, spelled in found.items() if spelled is None]
    if missing:
        raise ValueError(f"{what}: no such column: {', '.join(missing)}")
    return list(found.values())


def check_distinct(spark: SparkSession, names: Iterable[str], what: str) -> None:
    """Fail when two names are the same column to Spark."""
    fold = _fold(spark)
    counts = Counter(fold(name) for name in names)
    twice = [name for name, n in counts.items() if n > 1]
    if twice:
        raise ValueError(f"{what}: duplicate column: {', '.join(twice)}")


def orderable(data_type: T.DataType) -> bool:
    """Whether Spark can sort by values of this type."""
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))
