"""Run a registered query and its check SQL side by side."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def spark_rows(df):
    order = sorted(df.columns)
    return order, sorted(map(repr, (tuple(r) for r in df.select(*order).collect())))


def sql_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    at = [names.index(n) for n in sorted(names)]
    return sorted(names), sorted(repr(tuple(row[i] for i in at)) for row in cursor.fetchall())
