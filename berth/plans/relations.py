"""Keys and references found in the tables, without being named."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from berth.operators import relations as rel
from berth.plans import sqltext
from berth.plans.registry import query, table, tables

_STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _keys_sql(name: str, most: int) -> str:
    """All minimal unique sets of a table by counting every set."""
    cols = [c for c, t in sqltext.columns(name) if not t.startswith("array")]
    rows = []
    for size in range(1, most + 1):
        for names in itertools.combinations(cols, size):
            whole = " AND ".join(f"count({c}) = count(*)" for c in names)
            rows.append(
                f"SELECT [{', '.join(repr(c) for c in names)}] AS s, count(*) AS n, count(*) > 0 AND {whole} AND "
                f"count(DISTINCT ({', '.join(names)})) = count(*) AS u FROM {name}"
            )
    return (
        f"WITH sets AS ({' UNION ALL '.join(rows)}), keys AS (SELECT s, n FROM sets WHERE u) "
        f"SELECT '{name}' AS table_name, array_to_string(s, ',') AS columns, n AS row_count FROM keys AS k "
        "WHERE NOT EXISTS (SELECT 1 FROM keys AS o WHERE len(o.s) < len(k.s) AND list_has_all(k.s, o.s))"
    )


def _keys(spark, sf_dir, name: str, most: int):
    found = rel.unique_sets(table(spark, sf_dir, name), name, most=most)
    return found.withColumn("columns", F.array_join("columns", ","))


@query("keys_conversations", _keys_sql("conversations", 3))
def keys_conversations(spark, sf_dir):
    return _keys(spark, sf_dir, "conversations", 3)


@query("keys_supplier", _keys_sql("supplier", 3))
def keys_supplier(spark, sf_dir):
    return _keys(spark, sf_dir, "supplier", 3)


@query("keys_orders", _keys_sql("orders", 2))
def keys_orders(spark, sf_dir):
    return _keys(spark, sf_dir, "orders", 2)


def _references_sql() -> str:
    kinds = {"int": "bigint", "bigint": "bigint", "string": "string"}
    cols = [(t, c, kinds[k]) for t in _STAR for c, k in sqltext.columns(t) if k in kinds]
    rows = []
    for ct, cc, ck in cols:
        for pt, pc, pk in cols:
            if ck == pk and (ct, cc) != (pt, pc):
                same = (cc.partition("_")[2] or cc) == (pc.partition("_")[2] or pc)
                rows.append(
                    f"SELECT '{ct}' AS child_table, '{cc}' AS child_column, '{pt}' AS parent_table, "
                    f"'{pc}' AS parent_column, (SELECT count(DISTINCT {cc}) FROM {ct}) AS child_values, "
                    f"(SELECT count(*) FROM {pt}) AS parent_values, {str(same).lower()} AS same_name, "
                    f"(SELECT count(*) = count(DISTINCT {pc}) AND count(*) = count({pc}) FROM {pt}) AND "
                    f"(SELECT count({cc}) > 0 FROM {ct}) AND "
                    f"NOT EXISTS (SELECT 1 FROM {ct} WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM {pt})) AS holds"
                )
    return f"SELECT * EXCLUDE (holds) FROM ({' UNION ALL '.join(rows)}) WHERE holds"


@query("references_found", _references_sql())
def references_found(spark, sf_dir):
    return rel.references(tables(spark, sf_dir, *_STAR))
