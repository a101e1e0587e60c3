"""What the database reader asks for; no database is started."""

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftscore.sources.jdbc import MOST_KEYS, KeyRange, jdbc_reader, key_predicates
from shiftscore.sources.warehouse import RELATIONS, load_warehouse


@settings(max_examples=60, deadline=None)
@given(st.integers(-50, 50), st.integers(0, 200), st.integers(1, 40))
def test_every_value_meets_exactly_one_range(lower, span, queries):
    predicates = KeyRange("k", lower, lower + span, queries).predicates()
    assert len(predicates) <= queries
    met = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    values = "SELECT i AS k FROM range(-400, 400) t(i) UNION ALL SELECT NULL"
    assert duckdb.sql(f"SELECT min({met}), max({met}) FROM ({values})").fetchall() == [(1, 1)]


def test_bad_ranges_are_refused():
    for bad in (KeyRange("k", 2, 1, 4), KeyRange("k", 1, 2, 0)):
        with pytest.raises(ValueError):
            bad.predicates()


def test_keys_are_pushed_in_bounded_lists():
    keys = [*range(2500, 0, -1), 7, None]
    predicates = key_predicates("id", keys)
    assert [p.count(",") + 1 for p in predicates] == [1000, 1000, 500]
    rows = duckdb.sql(f"SELECT i FROM range(0, 4000) t(i) WHERE {' OR '.join(p.replace('id', 'i') for p in predicates)}").fetchall()
    assert sorted(r[0] for r in rows) == list(range(1, 2501))
    assert key_predicates("phone", ["9'x", "8"]) == ["phone IN ('8', '9''x')"]
    assert key_predicates("id", []) == key_predicates("id", [None]) == ["1 = 0"]
    with pytest.raises(ValueError, match="restrict by a join"):
        key_predicates("id", range(MOST_KEYS + 1))
    with pytest.raises(TypeError):
        key_predicates("id", [1.5])


def test_the_warehouse_is_read_by_keys_ranges_or_whole():
    asked = {}

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            asked[table] = (url, predicates, properties)
            return table

    class Session:
        read = Reader()

    wh = load_warehouse(None, reader=jdbc_reader(
        Session(), "jdbc:x://host/db", {"user": "u"}, names={"orders": "oms.orders"}, ranges={"orders": KeyRange("order_id", 0, 999, 4)},
        keys={"customers": ("mobile", ["900"]), "customer_app_events": ("customer_id", [1, 2])}))
    assert set(asked) == {"oms.orders" if r == "orders" else r for r in RELATIONS} and wh.orders == "oms.orders"
    assert asked["customers"] == ("jdbc:x://host/db", ["mobile IN ('900')"], {"user": "u"})
    assert asked["customer_app_events"][1] == ["customer_id IN (1, 2)"]
    assert asked["oms.orders"][1] == ["order_id < 250 OR order_id IS NULL", "order_id >= 250 AND order_id < 500",
                                      "order_id >= 500 AND order_id < 750", "order_id >= 750"]
    assert asked["geo_regions"][1] is None
