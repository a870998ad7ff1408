"""The database sink over a stand-in that keeps tables and applies statements; no database is started."""

import re

import pytest

from vanescope.sinks import database


class Tables:
    """Tables as lists of rows. A transaction works on a copy, which replaces them when it ends."""

    def __init__(self):
        self.rows, self.seen, self.settings = {}, [], []

    def execute(self, statements):
        copy = {name: list(rows) for name, rows in self.rows.items()}
        for sql in statements:
            if found := re.fullmatch(r"DELETE FROM (\S+)", sql):
                copy[found[1]] = []
            elif found := re.fullmatch(r"INSERT INTO (\S+) \((.+)\) SELECT (.+) FROM (\S+)", sql):
                assert found[2] == found[3] == '"id", "Wind ""x"""'
                copy[found[1]] = copy[found[1]] + copy[found[4]]
            elif found := re.fullmatch(r"DROP TABLE IF EXISTS (\S+)", sql):
                copy.pop(found[1], None)
            else:
                raise AssertionError(sql)
        self.rows = copy


class Writer:
    def __init__(self, frame):
        self.frame, self.given, self.how = frame, {}, None

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def mode(self, how):
        self.how = how
        return self

    def option(self, name, value):
        self.given[name] = value
        return self

    def options(self, **given):
        self.given |= given
        return self

    def save(self):
        tables, name = self.frame.tables, self.given["dbtable"]
        tables.settings.append((self.how, self.given))
        old = tables.rows.get(name, []) if self.how == "append" else []
        written = self.frame.rows if not self.frame.faults or not self.frame.rows else self.frame.faults.pop(0)
        if isinstance(written, Exception):
            # What some tasks have committed stays.
            tables.rows[name] = old + self.frame.rows[:1]
            raise written
        tables.rows[name] = old + written
        # Whoever reads now sees this.
        tables.seen.append(list(tables.rows.get("t", [])))


class Frame:
    sparkSession = None
    columns = ["id", 'Wind "x"']

    def __init__(self, tables, rows, faults=()):
        self.tables, self.rows, self.faults = tables, rows, list(faults)

    def count(self):
        return len(self.rows)

    def limit(self, n):
        return Frame(self.tables, self.rows[:n])

    @property
    def write(self):
        return Writer(self)


@pytest.fixture
def tables(monkeypatch):
    kept = Tables()

    class Answer:
        def __init__(self, name):
            self.name = name

        def first(self):
            return [len(kept.rows[self.name])]

    monkeypatch.setattr(database, "read_query", lambda _, sql, __: Answer(sql.split()[-1]))
    return kept


def write(tables, rows, faults=(), **how):
    database.write_table(Frame(tables, rows, faults), "t", {"url": "jdbc:x"}, execute=tables.execute, **how)


def test_rows_are_replaced_and_the_stage_goes(tables):
    write(tables, [1, 2, 3], connections=4)
    assert tables.rows == {"t": [1, 2, 3]}
    write(tables, [4, 5])
    assert tables.rows == {"t": [4, 5]}
    staged = [s for _, s in tables.settings if s["dbtable"] != "t"]
    assert staged[0]["numPartitions"] == 4 and len({s["dbtable"] for s in staged}) == 2
    # Until the swap readers saw the rows of before.
    assert tables.seen[-1] == [1, 2, 3]


def test_repeated_rows_are_staged_anew_and_never_seen(tables):
    write(tables, [1, 2])
    write(tables, [3, 4, 5], faults=[[3, 4, 5, 5]])
    assert tables.rows == {"t": [3, 4, 5]}
    assert all(seen in ([], [1, 2]) for seen in tables.seen)


def test_failed_attempts_leave_the_old_rows(tables):
    write(tables, [1, 2])
    with pytest.raises(RuntimeError, match="as it was"):
        write(tables, [3, 4], faults=[[3], [3, 4, 4]], attempts=2)
    assert tables.rows == {"t": [1, 2]}
    with pytest.raises(OSError):
        write(tables, [3, 4], faults=[OSError("lost")])
    assert tables.rows == {"t": [1, 2]}


def test_a_failing_swap_leaves_the_old_rows(tables):
    write(tables, [1, 2])

    def broken(statements):
        if statements[0].startswith("DELETE"):
            tables_copy = Tables()
            tables_copy.rows = tables.rows
            tables_copy.execute(statements[:1])
            raise OSError("connection lost in the middle")
        tables.execute(statements)

    with pytest.raises(OSError):
        database.write_table(Frame(tables, [7]), "t", {"url": "jdbc:x"}, execute=broken)
    assert tables.rows == {"t": [1, 2]}


def test_tables_without_rows(tables):
    write(tables, [])
    assert tables.rows == {"t": []}
    write(tables, [1])
    write(tables, [])
    assert tables.rows == {"t": []}


def test_names_of_stages():
    assert database.staging_name("t", "ab") == "t_ab"
    assert database.staging_name('"Processed_data"', "ab") == '"Processed_data_ab"'
    assert database.staging_name('public."T"', "ab") == 'public."T_ab"'
    assert len(database.staging_name("x" * 80, "0123456789ab")) == 63


class Connection:
    def __init__(self, log, fails):
        self.log, self.fails = log, fails

    def setAutoCommit(self, on):
        self.log.append(f"auto {on}")

    def createStatement(self):
        return self

    def execute(self, sql):
        if sql == self.fails:
            raise OSError(sql)
        self.log.append(sql)

    def __getattr__(self, name):
        return lambda: self.log.append(name)


@pytest.mark.parametrize("fails", [None, "b"])
def test_one_transaction(fails):
    from types import SimpleNamespace as Names

    log, given = [], {}

    class Properties:
        def setProperty(self, name, value):
            given[name] = value

    manager = Names(getConnection=lambda url, _: Connection(log, fails))
    spark = Names(_jvm=Names(java=Names(util=Names(Properties=Properties), sql=Names(DriverManager=manager))))
    settings = {"url": "jdbc:x", "user": "u", "password": "p"}
    if fails:
        with pytest.raises(OSError):
            database.run_in_one_transaction(spark, settings, ["a", "b"])
        assert log == ["auto False", "a", "rollback", "close"]
    else:
        database.run_in_one_transaction(spark, settings, ["a", "b"])
        assert log == ["auto False", "a", "b", "commit", "close"]
    assert given == {"user": "u", "password": "p"}
