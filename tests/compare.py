"""Side-by-side run of a query and its SQL check, compared row for row in DuckDB."""

from __future__ import annotations

import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str, folder: str) -> str | None:
    """What differs between the two results, or None."""
    relation = con.sql(sql)
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    mine = dict(spark_df.dtypes)
    if set(mine) != set(types):
        return f"columns: only query {sorted(set(mine) - set(types))[:9]}, only SQL {sorted(set(types) - set(mine))[:9]}"
    odd = {c: (t, types[c]) for c, t in mine.items() if SAME_TYPE.get(t) != types[c]}
    if odd:
        return f"types: {dict(list(odd.items())[:9])}"
    spark_df.write.parquet(folder)
    con.execute(f"CREATE OR REPLACE TEMP TABLE wanted AS {sql}")
    columns = ", ".join(f'"{c}"' for c in sorted(mine))
    got = f"SELECT {columns} FROM '{folder}/*.parquet'"
    wanted = f"SELECT {columns} FROM wanted"
    counts = [con.execute(f"SELECT count(*) FROM ({q})").fetchone()[0] for q in (got, wanted)]
    if counts[0] != counts[1]:
        return f"rows: query {counts[0]}, SQL {counts[1]}"
    extra = con.execute(f"SELECT * FROM ({got} EXCEPT ALL {wanted}) LIMIT 3").fetchall()
    if extra:
        lost = con.execute(f"SELECT * FROM ({wanted} EXCEPT ALL {got}) LIMIT 3").fetchall()
        return f"query only {str(extra)[:600]}, SQL only {str(lost)[:600]}"
    return None
