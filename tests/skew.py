"""Write a skewed copy of a table directory: skew.py SOURCE TARGET.

One key of every kind holds a third of its rows: an order, a part, a day, a
customer, a user, a name, a text and a group of equal vectors.  Compare with
`check.py TARGET`.
"""

import sys

import duckdb

THIRDS = {
    "customer": {"c_nationkey": "5", "c_mktsegment": "'BUILDING'"},
    "part": {"p_name": "'red ring'", "p_brand": "'Brand#2'", "p_size": "7"},
    "orders": {"o_custkey": "42", "o_orderdate": "TIMESTAMP '1997-03-05'"},
    "lineitem": {"l_orderkey": "77", "l_partkey": "123", "l_shipdate": "TIMESTAMP '1998-06-01'"},
    "events": {"user_id": "3", "event_type": "'click'"},
    "documents": {"text": "first(text) OVER ()", "n_chars": "first(n_chars) OVER ()"},
    "embeddings": {"embedding": "first(embedding) OVER ()", "label": "4"},
}


def main(source: str, target: str) -> None:
    from millrace.sources.tables import NAMES

    connection = duckdb.connect()
    for name in NAMES:
        table = connection.sql(f"SELECT * FROM '{source}/{name}.parquet'")
        hot = {
            # Each column of a table has its own third.
            column: f"CASE WHEN _row % 3 = {i % 3} THEN {value} ELSE {column} END"
            for i, (column, value) in enumerate(THIRDS.get(name, {}).items())
        }
        if name == "documents":
            hot = {c: v.replace("_row % 3 = 1", "_row % 3 = 0") for c, v in hot.items()}
        columns = ", ".join(
            f"({hot.get(c, c)})::{t} AS {c}" for c, t in zip(table.columns, table.types)
        )
        connection.execute(
            f"COPY (SELECT {columns} FROM (SELECT *, row_number() OVER () AS _row FROM '{source}/{name}.parquet'))"
            f" TO '{target}/{name}.parquet' (FORMAT parquet)"
        )


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    main(*sys.argv[1:3])
