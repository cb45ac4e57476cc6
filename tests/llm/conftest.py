import duckdb
import pytest


@pytest.fixture
def rows_of():
    """Rows as sorted tuples, in the order of the given columns."""

    def rows(df, *columns):
        return sorted(map(tuple, df.select(*columns).collect()), key=str)

    return rows


@pytest.fixture
def duck(request):
    """DuckDB with tables given as (name, column list, rows)."""

    def connect(**tables):
        con = duckdb.connect()
        for name, (columns, rows) in tables.items():
            con.execute(f"CREATE TABLE {name} ({columns})")
            if rows:
                con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
        return con

    return connect
