"""SQL for contract suites."""

from __future__ import annotations

from storeloom.operators.contracts import (BETWEEN, BRONZE_SUITES, COLUMN_COUNT, EXIST, IN_SET,
                                           LENGTH, NOT_NULL, ROW_COUNT, SILVER_SUITES, UNIQUE)

from oracle.base import hits, pct

# Columns of the tables under contract; silver tables carry three audit columns more.
COLUMN_COUNTS = {("bronze", "orders"): 8, ("bronze", "customers"): 5, ("bronze", "order_items"): 7,
                 ("silver", "customers"): 11, ("silver", "orders"): 14,
                 ("silver", "products"): 17, ("silver", "order_items"): 14}


def _literal(value) -> str:
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _rule_sql(layer: str, table: str, position: int, rule: dict) -> str:
    kind, args = rule["expectation_type"], rule["kwargs"]
    source, c = f"{layer[0]}_{table}", args.get("column")
    mostly = float(args.get("mostly", 1.0))
    evaluated = unexpected = observed = "NULL"
    if kind == EXIST:
        success = "count(*) >= 0"
    elif kind == COLUMN_COUNT:
        observed = str(COLUMN_COUNTS[layer, table])
        success = f"count(*) >= 0 AND {observed} = {args['value']}"
    elif kind == ROW_COUNT:
        observed = "count(*)"
        success = f"count(*) BETWEEN {args['min_value']} AND {args['max_value']}"
    else:
        evaluated = "count(*)" if kind == NOT_NULL else f"count({c})"
        if kind == UNIQUE:
            unexpected = "sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)"
            source = f"(SELECT {c}, count(*) OVER (PARTITION BY {c}) AS n FROM {source} WHERE {c} IS NOT NULL)"
        else:
            unexpected = hits({
                NOT_NULL: lambda: f"{c} IS NULL",
                IN_SET: lambda: f"{c} NOT IN ({', '.join(map(_literal, args['value_set']))})",
                BETWEEN: lambda: f"{c} NOT BETWEEN {args['min_value']} AND {args['max_value']}",
                LENGTH: lambda: f"length({c}) <> {args['value']}"}[kind]())
        success = f"{evaluated} = 0 OR {evaluated} - {unexpected} >= {evaluated} * {mostly}::DOUBLE"
    name = "NULL" if c is None else f"'{c}'"
    return f"""SELECT {position} AS position, '{kind}' AS expectation_type,
        CAST({name} AS VARCHAR) AS column_name, CAST({evaluated} AS BIGINT) AS evaluated,
        CAST({unexpected} AS BIGINT) AS unexpected, CAST({observed} AS BIGINT) AS observed,
        CAST({mostly} AS DOUBLE) AS mostly, {success} AS success FROM {source}"""


def suite_sql(layer: str, table: str, suite: list[dict]) -> str:
    return " UNION ALL ".join(_rule_sql(layer, table, i, r) for i, r in enumerate(suite, 1))


def statistics_sql(layer: str, table: str, suite: list[dict]) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) AS evaluated, {hits('success')} AS successful,
        {hits('NOT success')} AS unsuccessful, {pct(hits('success'), 'count(*)')} AS success_percent,
        bool_and(success) AS success FROM ({suite_sql(layer, table, suite)})"""


def checkpoints_sql() -> str:
    runs = [("bronze", t, s, "run-1", "2002-01-01") for t, s in BRONZE_SUITES.items()]
    runs += [("silver", t, s, "run-2", "2002-01-02") for t, s in SILVER_SUITES.items()]
    return " UNION ALL ".join(
        f"""SELECT '{layer}_{t}' AS suite, '{run}' AS run_id, TIMESTAMP '{at}' AS run_at, *
        FROM ({suite_sql(layer, t, s)})""" for layer, t, s, run, at in runs)


def failures_sql() -> str:
    return f"""SELECT suite, position, expectation_type, column_name FROM ({checkpoints_sql()})
        WHERE NOT success"""
