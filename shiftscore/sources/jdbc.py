"""The warehouse relations from a live database.

``load_warehouse(spark, reader=jdbc_reader(...))`` reads each relation in
parallel, one query for each predicate, so no relation comes through a single
connection.  A relation with keys in hand is read by them (the lead phones or
customer ids, as the original pushes them), in lists of bounded length; one
without is read by ranges of a column.  Both are exact: ranges leave no value
out, whatever the bounds, and NULLs are in the first one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Keys in one query, and keys that may be pushed at all: more are read by ranges and restricted by a join.
KEYS_PER_QUERY, MOST_KEYS = 1_000, 100_000


@dataclass(frozen=True)
class KeyRange:
    """A whole-number column, about where its values lie, and the number of queries."""

    column: str
    lower: int
    upper: int
    queries: int

    def predicates(self) -> list[str]:
        """Conditions of which every value, and NULL, meets exactly one."""
        if self.queries < 1 or self.upper < self.lower:
            raise ValueError("a range has a lower bound, an upper one not below it, and a query at least")
        span = self.upper - self.lower + 1
        cuts = sorted({self.lower + span * k // self.queries for k in range(1, self.queries)} - {self.lower})
        if not cuts:
            return ["1 = 1"]
        between = [f"{self.column} >= {a} AND {self.column} < {b}" for a, b in zip(cuts, cuts[1:])]
        return [f"{self.column} < {cuts[0]} OR {self.column} IS NULL", *between, f"{self.column} >= {cuts[-1]}"]


def _sql(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, str)):
        raise TypeError(f"a key is a whole number or a text, not {value!r}")
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def key_predicates(column: str, keys: Sequence, per_query: int = KEYS_PER_QUERY) -> list[str]:
    """Conditions that together are ``column IN (keys)``, each key in one of them; no key gives no row."""
    found = sorted({k for k in keys if k is not None})
    if len(found) > MOST_KEYS:
        raise ValueError(f"{len(found)} keys are too many to push (at most {MOST_KEYS}): read by a range and restrict by a join")
    return [f"{column} IN ({', '.join(map(_sql, found[k:k + per_query]))})" for k in range(0, len(found), per_query)] or ["1 = 0"]


def jdbc_reader(spark: SparkSession, url: str, properties: dict[str, str], *, ranges: dict[str, KeyRange] | None = None,
                keys: dict[str, tuple[str, Sequence]] | None = None, names: dict[str, str] | None = None) -> Callable[[str], DataFrame]:
    """A reader for ``load_warehouse``.

    ``keys`` gives a relation's key column and the keys in hand, ``ranges`` a
    column to read by; a relation with neither is a small one, read in one
    query.  ``names`` maps relations to the database's table names.
    """
    ranges, keys, names = ranges or {}, keys or {}, names or {}

    def read(relation: str) -> DataFrame:
        table = names.get(relation, relation)
        if relation in keys:
            return spark.read.jdbc(url, table, predicates=key_predicates(*keys[relation]), properties=properties)
        if relation in ranges:
            return spark.read.jdbc(url, table, predicates=ranges[relation].predicates(), properties=properties)
        return spark.read.jdbc(url, table, properties=properties)

    return read
