"""The same results as plain SQL over the given tables."""

from __future__ import annotations

CENTS = "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)"
LINES = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,"
    " l_discount, l_tax, l_linestatus, l_shipdate"
)
HISTORY = "o_orderdate < TIMESTAMP '2000-01-01'"
N_HISTORY = f"(SELECT count(*) FROM orders WHERE {HISTORY})"
N_ORDERS = "(SELECT count(*) FROM orders)"
N_CUSTOMER = "(SELECT count(*) FROM customer)"
N_SUPPLIER = "(SELECT count(*) FROM supplier)"
N_LINEITEM = "(SELECT count(*) FROM lineitem)"


def values(columns: str, *rows: str) -> str:
    """A few result rows, each a list of SQL expressions."""
    first, *others = rows
    named = ", ".join(f"{value} AS {name}" for name, value in zip(columns.split(), first.split("; ")))
    return " UNION ALL ".join([f"SELECT {named}", *[f"SELECT {row.replace('; ', ', ')}" for row in others]])


def explained(names: tuple[str, ...], share: float) -> str:
    """The smallest groups with a share of the changed rows of lineitem: all subsets, then those without a heavy one within."""
    same = " AND ".join(f"(h.f_{n} = 0 OR k.f_{n} = 1 AND h.{n} IS NOT DISTINCT FROM k.{n})" for n in names)
    count = lambda t: " + ".join(f"{t}.f_{n}" for n in names)
    listed, flags = ", ".join(names), ", ".join(f"1 - grouping({n}) AS f_{n}" for n in names)
    fixed = ", ".join(f"CASE WHEN f_{n} = 1 THEN '{n}' END" for n in names)
    return (
        "WITH b AS (SELECT * FROM lineitem), added AS (SELECT * REPLACE (-1 - l_orderkey AS l_orderkey) FROM b WHERE l_orderkey % 25 = 0),"
        " u AS (SELECT * REPLACE (CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND year(l_shipdate) = 1994 AND l_orderkey > 0 THEN l_tax + 1 ELSE l_tax END AS l_tax)"
        " FROM (SELECT * FROM b UNION ALL SELECT * FROM added)),"
        " a AS (SELECT * FROM u WHERE NOT (l_linenumber = 3 AND l_quantity > 25)),"
        " d AS (SELECT *, 1 AS plus, 0 AS minus FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)"
        " UNION ALL SELECT *, 0, 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)),"
        " e AS (SELECT l_returnflag, l_linestatus, year(l_shipdate)::INTEGER AS ship_year, l_linenumber, l_orderkey < 0 AS copied, plus, minus FROM d),"
        f" g AS (SELECT {listed}, {flags}, sum(plus)::BIGINT AS n_added, sum(minus)::BIGINT AS n_removed FROM e GROUP BY CUBE ({listed})),"
        f" h AS (SELECT * FROM g WHERE n_added + n_removed >= {share}::DOUBLE * (SELECT count(*) FROM e))"
        f" SELECT concat_ws(', ', {fixed}) AS fixed, {listed}, n_added, n_removed, (SELECT count(*) FROM e) AS n_total FROM h"
        f" WHERE NOT EXISTS (SELECT 1 FROM h k WHERE {count('k')} = {count('h')} + 1 AND {same})"
    )


def profiled(numbers: tuple[str, ...], others: tuple[str, ...]) -> str:
    """Exact counts and bounds of the columns of lineitem, as given and changed."""
    return (
        "WITH more AS (SELECT * REPLACE (-1 - l_orderkey AS l_orderkey, CAST(NULL AS DOUBLE) AS l_discount) FROM lineitem WHERE l_orderkey % 25 = 0),"
        " t AS (SELECT 'main' AS ref, * FROM lineitem UNION ALL"
        " SELECT 'changed', * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM more) WHERE NOT (l_linenumber = 3 AND l_quantity > 25)) "
    ) + " UNION ALL ".join(
        f"SELECT ref, '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS n_values, {bound('min', c)} AS least, {bound('max', c)} AS most,"
        f" true AS distinct_holds, {'true' if c in numbers else 'CAST(NULL AS BOOLEAN)'} AS quantiles_hold FROM t GROUP BY ref"
        for c in (*numbers, *others)
        for bound in [lambda of, c: f"{of}({c})::DOUBLE" if c in numbers else "CAST(NULL AS DOUBLE)"]
    )


ORACLES: dict[str, str] = {
    "csv_header_scan": "SELECT * FROM customer",
    "csv_headerless_scan": (
        "SELECT count(*) AS n_data_rows, CAST(1 AS BIGINT) AS fewest_headers_per_file,"
        " CAST(1 AS BIGINT) AS most_headers_per_file FROM orders"
    ),
    "stage_load_overwrite": "SELECT * FROM part",
    "parquet_scan": (
        "SELECT r_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey"
        " JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"
    ),
    "temp_view_sql": (
        "SELECT CAST(s_nationkey AS VARCHAR) AS s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey"
    ),
    "scan_current_ref": f"SELECT o_orderstatus, count(*) AS n_rows, {CENTS} AS cents FROM orders GROUP BY 1",
    "scan_at_ref": (
        f"SELECT 'dev' AS ref, o_orderstatus, count(*) AS n_rows FROM orders WHERE {HISTORY} GROUP BY 2"
        " UNION ALL SELECT 'etl', o_orderstatus, count(*) FROM orders GROUP BY 2"
        " UNION ALL SELECT 'experiment', o_orderstatus, 2 * count(*) FROM orders GROUP BY 2"
        " UNION ALL SELECT 'main', o_orderstatus, count(*) FROM orders GROUP BY 2"
    ),
    "sql_pinned_table": values("ref n_rows", f"'experiment'; 2 * {N_ORDERS}", f"'main'; {N_ORDERS}"),
    "use_ref": (
        "SELECT 'experiment' AS ref, o_orderpriority, 2 * count(*) AS n_rows FROM orders GROUP BY 2"
        " UNION ALL SELECT 'main', o_orderpriority, count(*) FROM orders GROUP BY 2"
    ),
    "create_namespace": values(
        "namespace on_branch on_main n_rows",
        f"'archive'; CAST(1 AS BIGINT); CAST(0 AS BIGINT); {N_CUSTOMER}",
        f"'shop'; 1; 1; {N_CUSTOMER}",
    ),
    "create_table_if_absent": values(
        '"table" n_rows', f"'shop.supplier'; {N_SUPPLIER}", "'shop.nothing_yet'; CAST(0 AS BIGINT)"
    ),
    "drop_column": "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
    "rename_table": "SELECT * FROM supplier",
    "drop_table": values(
        'ref "table" n_rows',
        f"'main'; 'shop.customer'; {N_CUSTOMER}",
        f"'main'; 'shop.orders'; {N_ORDERS}",
        f"'main'; 'shop.supplier'; {N_SUPPLIER}",
        f"'experiment'; 'shop.orders'; 2 * {N_ORDERS}",
        f"'experiment'; 'shop.supplier'; {N_SUPPLIER}",
    ),
    "list_tables_at_ref": values(
        'ref "table" n_rows',
        f"'dev'; 'shop.customer'; {N_CUSTOMER}",
        f"'dev'; 'shop.orders'; {N_HISTORY}",
        f"'etl'; 'shop.customer'; {N_CUSTOMER}",
        f"'etl'; 'shop.orders'; {N_ORDERS}",
        f"'etl'; 'shop.supplier'; {N_SUPPLIER}",
        f"'main'; 'shop.customer'; {N_CUSTOMER}",
        f"'main'; 'shop.orders'; {N_ORDERS}",
        f"'main'; 'shop.supplier'; {N_SUPPLIER}",
        f"'experiment'; 'shop.orders'; 2 * {N_ORDERS}",
        f"'experiment'; 'shop.supplier'; {N_SUPPLIER}",
    ),
    "append_select": "SELECT * FROM orders",
    "append_at_ref": "SELECT * FROM orders",
    "append_values": (
        "SELECT * FROM orders UNION ALL SELECT * FROM (VALUES"
        " (-1, 7, 'O', CAST(1.25 AS DOUBLE), TIMESTAMP '2002-01-01', '1-URGENT'),"
        " (-2, 7, 'O', CAST(2.25 AS DOUBLE), TIMESTAMP '2002-01-02', '2-HIGH'),"
        " (-3, 7, 'O', CAST(3.25 AS DOUBLE), TIMESTAMP '2002-01-03', NULL),"
        " (-4, 7, 'O', CAST(4.25 AS DOUBLE), TIMESTAMP '2002-01-04', '5-LOW'))"
    ),
    "overwrite_select": (
        f"SELECT 'branch' AS ref, count(*) AS n_rows, {CENTS} AS cents FROM orders WHERE o_orderstatus <> 'F'"
        f" UNION ALL SELECT 'main', count(*), {CENTS} FROM orders"
    ),
    "project_all": "SELECT * FROM supplier",
    "count_rows_by_ref": values(
        "ref n_rows",
        f"'dev'; {N_HISTORY}",
        f"'etl'; {N_ORDERS}",
        f"'experiment'; 2 * {N_ORDERS}",
        f"'main'; {N_ORDERS}",
    ),
    "count_column": (
        "SELECT count(nullif(c_mktsegment, 'BUILDING')) AS n_values, count(*) AS n_rows FROM customer"
    ),
    "count_literal": "SELECT count(1) AS n FROM lineitem",
    "create_ref": values(
        '"table" n_rows new_batches',
        f"'shop.orders'; {N_ORDERS}; CAST(0 AS BIGINT)",
        f"'shop.customer'; {N_CUSTOMER}; 0",
        f"'shop.lineitem'; {N_LINEITEM}; 0",
    ),
    "create_ref_at_commit": (
        f"SELECT 'older' AS ref, count(*) AS n_rows, {CENTS} AS cents FROM orders"
        " UNION ALL SELECT 'moved', 2 * count(*), 0 FROM orders"
    ),
    "list_refs": values(
        "ref_type ref n_rows",
        f"'Branch'; 'dev'; {N_HISTORY} + {N_CUSTOMER}",
        f"'Branch'; 'etl'; {N_ORDERS} + {N_CUSTOMER} + {N_SUPPLIER}",
        f"'Branch'; 'experiment'; 2 * {N_ORDERS} + {N_SUPPLIER}",
        f"'Branch'; 'main'; {N_ORDERS} + {N_CUSTOMER} + {N_SUPPLIER}",
    ),
    "drop_ref": values('ref_type ref "table" n_rows', f"'Branch'; 'main'; 'shop.customer'; {N_CUSTOMER}"),
    "orphan_batches": values("n_orphan_batches n_rows", f"CAST(1 AS BIGINT); {N_ORDERS}"),
    "ref_heads": values(
        "stage ref same_as_main n_rows",
        "'1 branched'; 'main'; true; CAST(0 AS BIGINT)",
        "'1 branched'; 'dev'; true; 0",
        "'2 dev loaded'; 'main'; true; 0",
        f"'2 dev loaded'; 'dev'; false; {N_HISTORY} + {N_CUSTOMER}",
        f"'3 dev merged'; 'main'; true; {N_HISTORY} + {N_CUSTOMER}",
        f"'3 dev merged'; 'dev'; true; {N_HISTORY} + {N_CUSTOMER}",
        f"'4 etl loaded'; 'main'; true; {N_HISTORY} + {N_CUSTOMER}",
        f"'4 etl loaded'; 'dev'; true; {N_HISTORY} + {N_CUSTOMER}",
        f"'4 etl loaded'; 'etl'; false; {N_ORDERS} + {N_CUSTOMER} + {N_SUPPLIER}",
        f"'5 etl merged'; 'main'; true; {N_ORDERS} + {N_CUSTOMER} + {N_SUPPLIER}",
        f"'5 etl merged'; 'dev'; false; {N_HISTORY} + {N_CUSTOMER}",
        f"'5 etl merged'; 'etl'; true; {N_ORDERS} + {N_CUSTOMER} + {N_SUPPLIER}",
        f"'6 experiment loaded'; 'main'; true; {N_ORDERS} + {N_CUSTOMER} + {N_SUPPLIER}",
        f"'6 experiment loaded'; 'dev'; false; {N_HISTORY} + {N_CUSTOMER}",
        f"'6 experiment loaded'; 'etl'; true; {N_ORDERS} + {N_CUSTOMER} + {N_SUPPLIER}",
        f"'6 experiment loaded'; 'experiment'; false; 2 * {N_ORDERS} + {N_SUPPLIER}",
    ),
    "commit_operations": values(
        'message "table" n_rows',
        f"'archive the orders'; 'shop.archive'; {N_ORDERS}",
        f"'archive the orders'; 'shop.orders'; {N_ORDERS}",
    ),
    "commit_log": values(
        "depth message rows_added",
        "CAST(0 AS BIGINT); 'start'; CAST(0 AS BIGINT)",
        "1; 'create namespace shop'; 0",
        "2; 'create table shop.orders'; 0",
        f"3; 'append to shop.orders'; {N_HISTORY}",
        "4; 'create table shop.customer'; 0",
        f"5; 'append to shop.customer'; {N_CUSTOMER}",
        f"6; 'append to shop.orders'; {N_ORDERS} - {N_HISTORY}",
        "7; 'drop column c_mktsegment of shop.customer'; 0",
        "8; 'create table shop.supplier'; 0",
        f"9; 'append to shop.supplier'; {N_SUPPLIER}",
        "10; 'drop table shop.customer'; 0",
        f"11; 'append to shop.orders'; {N_ORDERS}",
    ),
    "merge_ref": values(
        'stage "table" n_rows',
        f"'3 dev merged'; 'shop.orders'; {N_HISTORY}",
        f"'3 dev merged'; 'shop.customer'; {N_CUSTOMER}",
        f"'4 etl loaded'; 'shop.orders'; {N_HISTORY}",
        f"'4 etl loaded'; 'shop.customer'; {N_CUSTOMER}",
        f"'5 etl merged'; 'shop.orders'; {N_ORDERS}",
        f"'5 etl merged'; 'shop.customer'; {N_CUSTOMER}",
        f"'5 etl merged'; 'shop.supplier'; {N_SUPPLIER}",
        f"'6 experiment loaded'; 'shop.orders'; {N_ORDERS}",
        f"'6 experiment loaded'; 'shop.customer'; {N_CUSTOMER}",
        f"'6 experiment loaded'; 'shop.supplier'; {N_SUPPLIER}",
    ),
    "merge_diverged": values(
        '"table" n_rows n_customer_columns',
        f"'shop.orders'; 2 * {N_ORDERS}; 4",
        f"'shop.customer'; {N_CUSTOMER}; 4",
        f"'shop.supplier'; 2 * {N_SUPPLIER}; 4",
    ),
    "merge_conflicts": (
        "SELECT 'shop.orders' AS \"table\", count(*) AS rows_base, 2 * count(*) AS rows_source,"
        " count(*) FILTER (o_orderstatus <> 'F') AS rows_target FROM orders"
    ),
    "keyed_merge": (
        "SELECT c_custkey, c_name, c_nationkey,"
        " CASE c_mktsegment WHEN 'FURNITURE' THEN 0.0 WHEN 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END"
        " AS c_acctbal,"
        " CASE c_mktsegment WHEN 'MACHINERY' THEN 'INDUSTRY' ELSE c_mktsegment END AS c_mktsegment"
        " FROM customer WHERE NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0)"
        " UNION ALL SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
    ),
    "keyed_merge_conflicts": (
        "SELECT c_custkey, c_acctbal AS old_acctbal, c_acctbal + 1 AS our_acctbal,"
        " CASE WHEN c_acctbal < 0 THEN 'DEBTOR' END AS their_mktsegment FROM customer"
        " WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')"
        " AND (c_acctbal < 0 OR (c_acctbal > 9000 AND c_mktsegment = 'BUILDING'))"
    ),
    "reconcile_counts": values(
        'source_rows table_rows ok "table"',
        f"{N_ORDERS}; {N_ORDERS}; true; 'orders'",
        f"{N_CUSTOMER}; {N_CUSTOMER}; true; 'customer'",
        f"{N_SUPPLIER}; {N_SUPPLIER}; true; 'supplier'",
    ),
    "isolation_check": values(
        '"table" rows_on_experiment rows_on_main',
        f"'shop.orders'; 2 * {N_ORDERS}; {N_ORDERS}",
        f"'shop.customer'; CAST(0 AS BIGINT); {N_CUSTOMER}",
        f"'shop.supplier'; {N_SUPPLIER}; {N_SUPPLIER}",
    ),
    "row_diff": (
        "SELECT 'added' AS change, o.*, count(*) AS n_rows FROM"
        " (SELECT -1 - o_orderkey AS o_orderkey, o_custkey, o_orderstatus, -o_totalprice AS o_totalprice,"
        " o_orderdate, o_orderpriority FROM orders) o GROUP BY ALL"
    ),
    "row_diff_rewritten": (
        f"SELECT 'removed' AS change, {LINES}, 'R' AS l_returnflag, count(*) AS n_rows"
        " FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL"
        f" UNION ALL SELECT 'added', {LINES}, 'X', 2 * count(*)"
        " FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL"
    ),
    "schema_diff": values(
        "\"column\" type_main type_dev values_main values_dev",
        "'c_custkey'; 'bigint'; 'bigint'; (SELECT count(c_custkey) FROM customer);"
        " (SELECT count(c_custkey) FROM customer)",
        "'c_name'; 'string'; 'string'; (SELECT count(c_name) FROM customer); (SELECT count(c_name) FROM customer)",
        "'c_nationkey'; 'int'; 'int'; (SELECT count(c_nationkey) FROM customer);"
        " (SELECT count(c_nationkey) FROM customer)",
        "'c_acctbal'; 'double'; 'double'; (SELECT count(c_acctbal) FROM customer);"
        " (SELECT count(c_acctbal) FROM customer)",
        "'c_mktsegment'; NULL; 'string'; 0; (SELECT count(c_mktsegment) FROM customer)",
    ),
    "publish_gate": (
        "SELECT 'l_shipdate not null' AS rule, count(*) FILTER (l_shipdate IS NULL) AS n_failed,"
        " count(*) FILTER (l_shipdate IS NULL) = 0 AS passed FROM lineitem"
        " UNION ALL SELECT 'l_linestatus matches', n, n = 0 FROM (SELECT count(*) FILTER"
        " (l_linestatus IS NULL OR NOT regexp_full_match(l_linestatus, '[FO]')) AS n FROM lineitem)"
        " UNION ALL SELECT 'l_returnflag in set', n, n = 0 FROM (SELECT count(*) FILTER"
        " (l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N')) AS n FROM lineitem)"
        " UNION ALL SELECT 'l_orderkey, l_linenumber unique', n, n = 0 FROM (SELECT"
        " CAST(sum(c - 1) AS BIGINT) AS n FROM"
        " (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber))"
        " UNION ALL SELECT 'same count as source', CAST(0 AS BIGINT), true"
    ),
    "gated_publish": (
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment FROM customer"
    ),
    "stream_append": f"SELECT o_orderpriority, count(*) AS n_rows, {CENTS} AS cents FROM orders GROUP BY 1",
    "keyed_merge_duplicate_keys": (
        "SELECT path_limit, 'refused' AS outcome, 2 * count(*) AS n_rows, CAST(0 AS BIGINT) AS sum_keys"
        " FROM customer, (VALUES (0), (1), (1000)) AS l(path_limit) GROUP BY path_limit"
    ),
    "gated_publish_moved_target": (
        "SELECT 'refused' AS outcome, (SELECT count(*) FROM customer) AS customers, 2 * count(*) AS suppliers,"
        " count(*) AS named FROM supplier"
    ),
    "stream_after_rename": (
        f"SELECT 'renamed' AS ref, count(*) AS n_rows, {CENTS} AS cents FROM orders"
        f" UNION ALL SELECT 'anew', count(*), {CENTS} FROM orders"
        f" UNION ALL SELECT 'kept', count(*), {CENTS} FROM orders WHERE {HISTORY}"
    ),
    "delete_rows": (
        "WITH l AS (SELECT *, NOT (l_returnflag = 'R' AND l_quantity < 10)"
        " AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') AS stays FROM lineitem)"
        " SELECT 'kept' AS ref, l_returnflag, count(*) AS n_rows, CAST(sum(l_quantity::BIGINT) AS BIGINT) AS quantity,"
        " CAST(3 AS BIGINT) AS shared_batches FROM l GROUP BY 2 UNION ALL"
        " SELECT 'deleted', l_returnflag, count(*), CAST(sum(l_quantity::BIGINT) AS BIGINT), 3 FROM l WHERE stays GROUP BY 2"
    ),
    "update_rows": (
        "WITH l AS (SELECT *, l_shipdate < TIMESTAMP '1995-01-01' AS old FROM lineitem)"
        " SELECT * EXCLUDE (old) REPLACE (CASE WHEN old THEN l_tax ELSE l_discount END AS l_discount,"
        " CASE WHEN old THEN l_discount ELSE l_tax END AS l_tax, CASE WHEN old THEN 'Z' ELSE l_returnflag END AS l_returnflag) FROM l"
    ),
    "upsert_rows": (
        "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN lower(s_name) ELSE s_name END AS s_name, s_nationkey,"
        " CASE WHEN s_acctbal < 0 THEN 0.0 ELSE s_acctbal END::DOUBLE AS s_acctbal FROM supplier"
        " UNION ALL SELECT -s_suppkey, lower(s_name), s_nationkey, 0.0::DOUBLE FROM supplier WHERE s_acctbal < 0"
    ),
    "overwrite_partitions": (
        f"SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n_rows, CASE WHEN year(o_orderdate) = 1997 THEN 1 ELSE -1 END * {CENTS} AS cents"
        " FROM orders WHERE year(o_orderdate) = 1997 OR year(o_orderdate) IN (1995, 1996) AND o_orderstatus = 'F' GROUP BY 1, year(o_orderdate)"
    ),
    "evolve_columns": (
        "SELECT c_custkey, c_name AS c_label, c_nationkey::BIGINT + CASE WHEN c_acctbal >= 0 AND c_nationkey = 3 THEN 5000000000 ELSE 0 END AS c_nationkey,"
        " c_acctbal, CASE WHEN c_acctbal < 0 THEN 'debtor' END AS c_grade FROM customer"
    ),
    "revert_rows": "SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN '9-NONE' ELSE o_orderpriority END AS o_orderpriority) FROM orders",
    "revert_conflicts": (
        "SELECT * REPLACE (-1 - o_orderkey AS o_orderkey, -o_totalprice AS o_totalprice), CAST(2 AS BIGINT) AS n_missing"
        " FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
    ),
    "pick_rows": (
        "SELECT * FROM orders WHERE o_orderstatus <> 'P' UNION ALL"
        " SELECT orders.* REPLACE (-1 - o_orderkey AS o_orderkey, -o_totalprice AS o_totalprice) FROM orders, range(2) WHERE o_orderstatus = 'F'"
    ),
    "row_history": (
        "WITH c AS (SELECT c_custkey, c_mktsegment, c_acctbal, c_nationkey, CASE WHEN c_nationkey < 15 THEN 1 ELSE 2 END AS came,"
        " CASE WHEN c_nationkey = 3 THEN 5 END AS rewritten FROM customer)"
        " SELECT c_custkey, c_mktsegment, came::BIGINT AS valid_from,"
        " CASE WHEN c_acctbal < 0 THEN 3 WHEN c_acctbal > 9000 THEN 4 ELSE rewritten END::BIGINT AS valid_to FROM c"
        " UNION ALL SELECT c_custkey, 'DEBTOR', 3, rewritten FROM c WHERE c_acctbal < 0"
    ),
    "asof_events": (
        "WITH e AS (SELECT event_id, user_id, TIMESTAMP '1995-01-01' + to_seconds(80 * ((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000000)) AS moment FROM events)"
        " SELECT event_id, user_id, moment, o_orderkey, o_orderdate AS since FROM e LEFT JOIN orders ON o_custkey = user_id AND o_orderdate <= moment"
        " QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1"
    ),
    "windowed_stream": (
        "WITH e AS (SELECT date_trunc('day', ts) AS window_start, event_type, CAST(round(value * 100) AS BIGINT) AS c,"
        " ts < TIMESTAMP '2024-01-06' AND event_id % 10 = 0 AS held FROM events)"
        " SELECT window_start::TIMESTAMP AS window_start, event_type, count(*) AS n_rows, CAST(sum(c) AS BIGINT) AS cents,"
        " CASE WHEN NOT held THEN window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY END AS closed"
        " FROM e GROUP BY window_start, event_type, held"
    ),
    "session_stream": (
        "WITH e AS (SELECT user_id, ts, CAST(round(value * 100) AS BIGINT) AS c, day(ts) < 6 AND event_id % 10 = 0 AS late FROM events),"
        " b AS (SELECT *, coalesce(ts >= lag(ts) OVER w + INTERVAL 6 HOUR, true) AS begins FROM e WHERE NOT late WINDOW w AS (PARTITION BY user_id ORDER BY ts)),"
        " s AS (SELECT *, sum(begins::INTEGER) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM b)"
        " SELECT user_id, min(ts)::TIMESTAMP AS session_start, (max(ts) + INTERVAL 6 HOUR)::TIMESTAMP AS session_end, count(*) AS n_rows, CAST(sum(c) AS BIGINT) AS cents,"
        " max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM e WHERE NOT late) - INTERVAL 5 DAY AS closed FROM s GROUP BY user_id, n"
        " UNION ALL SELECT user_id, min(ts), NULL, count(*), CAST(sum(c) AS BIGINT), NULL FROM e WHERE late GROUP BY user_id"
    ),
    "explain_difference": explained(("l_returnflag", "l_linestatus", "ship_year", "l_linenumber", "copied"), 0.04),
    "profile_by_ref": profiled(
        ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        ("l_returnflag", "l_linestatus", "l_shipdate"),
    ),
    "gated_publish_drift": (
        "SELECT 'shop.orders: o_totalprice drifted; then merged' AS outcome, count(*) AS n_rows, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents"
        " FROM (SELECT o_totalprice FROM orders UNION ALL SELECT o_totalprice FROM orders WHERE o_orderkey % 10 = 0)"
    ),
    "maintained_totals": (
        "SELECT o_custkey, count(*) AS n_rows, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS cents,"
        " min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders WHERE o_orderstatus = 'P' OR NOT (o_orderpriority = '1-URGENT' OR o_custkey % 7 = 0) GROUP BY 1"
    ),
}
