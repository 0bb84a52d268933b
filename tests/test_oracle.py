"""Every registered query of the library against its SQL equivalent, and proof that fixtures hit the rules."""

import duckdb
import pytest

import __spark_entry__ as app
from registry import oracle, queries
from talkweave import rules

SF = "/root/testdata/sf0.001"
TABLES = ["conversations", "documents", "labels", "pages"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        number = isinstance(value, float) or type(value).__name__ == "Decimal"
        return repr(round(float(value), 6)) if number else repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    frame = queries.queries()[name](spark, SF)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert got == canonical(columns, cursor.fetchall())
    assert got


@pytest.mark.parametrize("label", list(rules.PII_PATTERNS) + [rules.PROFANITY_LABEL.strip("[]")])
def test_redaction_fixture_hits(duck, label):
    name = "redact_profanity" if label == "REDACTED" else f"redact_{label.lower()}"
    hits = duck.execute(
        f"SELECT count(*) FROM ({oracle.oracle_sql()[name]}) WHERE contains(safe_text, '[{label}]')"
    ).fetchone()[0]
    assert hits > 0


def test_language_fixture_hits(duck):
    found = {r[0] for r in duck.execute(oracle.oracle_sql()["lang_script"]).fetchall() for r in [r[-1:]]}
    assert {"Chinese", "Japanese", "Korean", "Arabic", "Hindi", "Turkish", "German"} <= found


def test_entry(spark):
    frame = app.entry(spark)
    assert frame.count() == 20
    assert "summary" in frame.columns
