"""The staged batch sink against a stand-in that knows its two statements, failing at every step."""

import re
from itertools import product

import pytest

from wattloom.sinks import jdbc
from wattloom.sinks.jdbc import staged_batch_sink

COPY = re.compile(
    r"INSERT INTO (\w+) \((.*)\) SELECT \2 FROM (\w+) WHERE NOT EXISTS "
    r"\(SELECT 1 FROM \1 WHERE (\w+) = (\d+)\)"
)
NOTE = re.compile(
    r"INSERT INTO (\w+) \(BATCH_ID, ROWS_WRITTEN\) SELECT (\d+), "
    r"\(SELECT COUNT\(\*\) FROM (\w+) WHERE (\w+) = \2\) WHERE NOT EXISTS "
    r"\(SELECT 1 FROM \1 WHERE BATCH_ID = \2\)"
)


class Store:
    """Tables as lists of dicts; fails before or after the steps it is told to."""

    def __init__(self):
        self.tables = {"t": [], "t_batches": []}
        self.failures, self.steps = set(), 0

    def step(self, change):
        self.steps += 1
        if (self.steps, "before") in self.failures:
            raise OSError("connection lost")
        change()
        if (self.steps, "after") in self.failures:
            raise OSError("connection lost")

    def write(self, df, url, table, properties, mode):
        assert mode == "overwrite"
        rows = [r.asDict() for r in df.collect()]
        self.step(lambda: self.tables.__setitem__(table, rows))

    def execute(self, statement):
        if match := COPY.fullmatch(statement):
            target, columns, staging, column, number = match.groups()
            names = columns.split(", ")

            def change():
                if not any(r[column] == int(number) for r in self.tables[target]):
                    self.tables[target] += [{c: r[c] for c in names} for r in self.tables[staging]]
        else:
            ledger, number, target, column = NOTE.fullmatch(statement).groups()

            def change():
                if not any(r["BATCH_ID"] == int(number) for r in self.tables[ledger]):
                    n = sum(r[column] == int(number) for r in self.tables[target])
                    self.tables[ledger].append({"BATCH_ID": int(number), "ROWS_WRITTEN": n})

        self.step(change)


@pytest.fixture
def store(monkeypatch):
    store = Store()
    monkeypatch.setattr(jdbc, "write_jdbc", store.write)
    return store


def content(store):
    return sorted((r["BATCH_ID"], r["x"]) for r in store.tables["t"])


FAILURES = [(step, when) for step, when in product((1, 2, 3), ("before", "after"))]


@pytest.mark.parametrize("first", FAILURES)
@pytest.mark.parametrize("second", [None, *FAILURES])
def test_every_batch_once_whatever_fails(spark, store, first, second):
    sink = staged_batch_sink("url", "t", {}, store.execute)
    for number, values in ((0, [1, 2]), (1, [2, 2, 3])):
        batch = spark.createDataFrame([(v,) for v in values], "x int")
        for failure in (first, second, None):
            store.steps, store.failures = 0, {failure}
            try:
                sink(batch, number)
            except OSError:
                assert failure is not None
                # A reader meets a batch whole or not at all.
                assert sum(b == number for b, _ in content(store)) in (0, len(values))
                continue
            assert failure is None
    assert content(store) == [(0, 1), (0, 2), (1, 2), (1, 2), (1, 3)]
    assert store.tables["t_batches"] == [
        {"BATCH_ID": 0, "ROWS_WRITTEN": 2},
        {"BATCH_ID": 1, "ROWS_WRITTEN": 3},
    ]


def test_a_batch_without_rows_is_noted(spark, store):
    staged_batch_sink("url", "t", {}, store.execute)(spark.createDataFrame([], "x int"), 4)
    assert content(store) == [] and store.tables["t_batches"] == [{"BATCH_ID": 4, "ROWS_WRITTEN": 0}]


def test_plain_names_only(spark, store):
    with pytest.raises(ValueError, match="names"):
        staged_batch_sink("url", "t; DROP TABLE t", {}, store.execute)
    sink = staged_batch_sink("url", "t", {}, store.execute)
    with pytest.raises(ValueError, match="names"):
        sink(spark.createDataFrame([(1,)], "`x y` int"), 0)
