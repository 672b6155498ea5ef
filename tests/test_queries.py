"""Registered queries against their SQL, on tables that the smallest driver tables don't stand for."""

import duckdb

from patrimonia.jobs import people as P
from patrimonia.jobs import registry

SF = "/root/testdata/sf0.001"


def compared(spark, folder, name):
    """(rows of the query, rows of its SQL), sorted, over the tables in ``folder`` and, where it has none, the smallest of the driver."""
    con = duckdb.connect()
    for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "nation"):
        path = folder / f"{t}.parquet"
        if not path.exists():
            path.symlink_to(f"{SF}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    want = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = registry.queries()[name](spark, str(folder)).select(*columns).collect()
    return sorted(map(repr, map(tuple, got))), sorted(map(repr, want.fetchall()))


def write(folder, name, sql):
    """A table of the driver as ``sql`` makes it of its smallest one."""
    duckdb.connect().execute(f"COPY ({sql.format(f"'{SF}/{name}.parquet'")}) TO '{folder}/{name}.parquet' (FORMAT parquet)")


def test_corrections_meet_their_own_declaration_beyond_a_million(spark, tmp_path):
    write(tmp_path, "orders", "SELECT * REPLACE (o_orderkey + 999950 AS o_orderkey) FROM {} WHERE o_orderkey < 150")
    write(tmp_path, "lineitem", "SELECT * REPLACE (l_orderkey + 999950 AS l_orderkey) FROM {} WHERE l_orderkey < 150")
    got, want = compared(spark, tmp_path, "apply_corrections")
    assert len(want) == 150 and got == want


def test_people_without_declarations_have_no_history(spark, tmp_path):
    write(tmp_path, "orders", "SELECT * FROM {} WHERE o_custkey % 5 <> 0")
    got, want = compared(spark, tmp_path, "assemble_people")
    assert sum(x.endswith(", -1)") for x in want) >= 10 and got == want


def test_flattened_items_are_checked_once(spark, tmp_path, monkeypatch):
    made = []
    check = P.check
    monkeypatch.setattr(P, "check", lambda read: made.append(read) or check(read))
    got, want = compared(spark, tmp_path, "flatten_items")
    assert want and got == want and len(made) == 1
