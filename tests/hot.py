"""A copy of the small test tables in which one key holds about a third of the rows of each table."""

from __future__ import annotations

import os

from tests.compare import connect

THIRD = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey)",
    "lineitem": "SELECT * REPLACE (CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey)",
    "documents": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'a copied text' ELSE text END AS text, "
    "CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END AS lang)",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'red ring' ELSE p_name END AS p_name)",
}


def write_hot_tables(source: str, folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    con = connect(source)
    for name in ("region", "nation", "customer", "labels", *THIRD):
        con.execute(f"COPY ({THIRD.get(name, 'SELECT *')} FROM {name}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder
