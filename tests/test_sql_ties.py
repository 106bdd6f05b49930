"""SQL that numbers clusters of sorted values leaves no ties to chance: it gives the same on one thread and on eight, where equal values come in any order."""

from __future__ import annotations

import duckdb
import pytest
from folio import queries
from test_queries import DATA

COPIES = 60


def told(name: str, threads: int) -> list[tuple]:
    con = duckdb.connect(config={"threads": threads})
    con.execute(f"CREATE TABLE lineitem AS SELECT x.* REPLACE (l_orderkey + k * 6000 AS l_orderkey) FROM '{DATA}/lineitem.parquet' x, range({COPIES}) r(k)")
    con.execute(f"CREATE TABLE events AS SELECT x.* REPLACE (user_id + k // 20 * 1000 AS user_id) FROM '{DATA}/events.parquet' x, range({COPIES * 20}) r(k)")
    sql = queries.ORACLES[name]
    if name == "slide_structures":  # few slides show a wrong cluster: the clusters themselves (its columns are slide_table's)
        sql = f"{sql.split(', b3 AS')[0]} SELECT deck_id, c, count(*), sum(bullet_x) FROM b2 GROUP BY ALL"
    return con.execute(f"SELECT count(*), sum(hash(o)) FROM ({sql}) o").fetchall()


@pytest.mark.parametrize("name", ["bullet_levels", "clusters_1d", "slide_table", "reliable_readings", "slide_structures"])
def test_same_on_any_number_of_threads(name):
    assert told(name, 1) == told(name, 8)
