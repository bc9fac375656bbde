"""Running queries against DuckDB."""

import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same_rows(spark, query, sql, folder=SF):
    """Asserts that a query and its SQL give the same rows under the same names."""
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = query(spark, folder)
    rows = found.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(found.columns)

    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    ours = sorted(tuple(str(plain(r[c])) for c in sorted(names)) for r in rows)
    at = [names.index(c) for c in sorted(names)]
    theirs = sorted(tuple(str(plain(r[i])) for i in at) for r in result.fetchall())
    assert ours == theirs
    return rows
