"""Run a query's SQL on the same tables and compare."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rounded(x):
    return float(f"{x:.9g}") if isinstance(x, float) else x


def answers(sql: str, sf: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    got = con.sql(sql)
    order = sorted(range(len(got.columns)), key=lambda i: got.columns[i])
    return [got.columns[i] for i in order], sorted((tuple(rounded(r[i]) for i in order) for r in got.fetchall()), key=repr)


def rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(rounded(r[c]) for c in names) for r in df.collect()), key=repr)
