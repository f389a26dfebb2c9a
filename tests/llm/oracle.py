"""Compare a query's rows with DuckDB's on the same tables."""

import duckdb


def rows_of_sql(sql, tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toArrow())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def same(frame, sql, tables):
    names, want = rows_of_sql(sql, tables)
    assert sorted(names) == sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*names).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def binary_digits(n, letters):
    """Thue-Morse string over two letters; a polynomial hash modulo a power of two can't tell it from its complement."""
    return "".join(letters[i.bit_count() % 2] for i in range(n))
