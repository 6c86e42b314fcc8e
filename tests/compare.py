"""Order-insensitive comparison of a Spark result with DuckDB's."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duckdb_tables(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return _sorted_rows(columns, result.fetchall())
