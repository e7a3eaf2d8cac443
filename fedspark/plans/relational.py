"""Relational queries: Spark SQL beside the SQL that an oracle runs.

``{name}`` stands for a table.  Where both engines read the same text, it is given once.
Sums of money are taken as decimals, so they do not hang on the order of rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MONEY = "CAST(sum(CAST({} AS DECIMAL(18,4))) AS DOUBLE)"
_AVG = "CAST(sum(CAST({} AS DECIMAL(18,4))) AS DOUBLE) / count({})"


def _money(x: str) -> str:
    return _MONEY.format(x)


def _avg(x: str) -> str:
    return _AVG.format(x, x)


_REVENUE = _money("l_extendedprice * (1 - l_discount)")

#: name: one text for both, or (Spark's, the oracle's).
SQL: dict[str, str | tuple[str, str]] = {
    "revenue_by_nation": f"""SELECT n_name, {_REVENUE} AS revenue FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
        JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
        WHERE l_returnflag = 'R' GROUP BY n_name ORDER BY revenue DESC, n_name LIMIT 10""",
    "pricing_summary": f"""SELECT l_returnflag, l_linestatus, {_money('l_quantity')} AS sum_qty, {_money('l_extendedprice')} AS sum_price, {_REVENUE} AS sum_disc,
        {_avg('l_quantity')} AS avg_qty, count(*) AS n FROM {{lineitem}} WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY l_returnflag, l_linestatus""",
    # scans and predicates
    "scan_parquet": "SELECT * FROM {part} WHERE p_size > 10",
    "values_inline": "SELECT * FROM (VALUES (1, 'a'), (2, 'b'), (3, NULL)) AS t(id, name)",
    "select_constant": "SELECT CAST(1 AS BIGINT) AS one, 'x' AS letter",
    "project_alias_expr": "SELECT l_orderkey AS ok, l_linenumber AS ln, l_extendedprice * (1 - l_discount) AS net, upper(l_returnflag) AS flag FROM {lineitem}",
    "filter_cmp": "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_totalprice >= 250000 AND o_orderstatus <> 'F' AND o_orderkey < 9000",
    "filter_and": "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_quantity > 20 AND l_discount <= 0.05 AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_returnflag = 'N'",
    "filter_or_not_between": "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE (l_returnflag = 'R' OR NOT l_quantity BETWEEN 5 AND 45) AND l_tax NOT IN (0.0, 0.01)",
    "filter_like": "SELECT p_partkey, p_name FROM {part} WHERE p_name LIKE '%a%' AND p_brand LIKE 'Brand#_2' AND p_type NOT LIKE 'X%'",
    "filter_ilike": "SELECT c_custkey, c_name FROM {customer} WHERE c_mktsegment ILIKE 'build%'",
    "filter_in": "SELECT c_custkey, c_mktsegment FROM {customer} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 3, 5, 7)",
    "filter_null": "SELECT c_custkey, o_orderkey FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey AND o_totalprice > 300000 WHERE o_orderkey IS NULL OR o_orderstatus IS NOT NULL",
    "filter_columns": "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_partkey < l_suppkey * 10 AND l_quantity > l_linenumber * 10",
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus FROM {lineitem}",
    "nested_field": (
        "SELECT event_id, u.id AS uid, u.k AS k FROM (SELECT event_id, named_struct('id', user_id, 'k', CAST(get_json_object(props, '$.k') AS BIGINT)) AS u FROM {events}) WHERE u.k > 50",
        "SELECT event_id, u.id AS uid, u.k AS k FROM (SELECT event_id, struct_pack(id := user_id, k := CAST(json_extract_string(props, '$.k') AS BIGINT)) AS u FROM {events}) WHERE u.k > 50",
    ),
    "struct_build": ("SELECT n_nationkey, named_struct('name', n_name, 'region', n_regionkey).name AS name FROM {nation}", "SELECT n_nationkey, struct_pack(name := n_name, region := n_regionkey).name AS name FROM {nation}"),
    "array_ops": (
        "SELECT vec_id, CAST(size(embedding) AS BIGINT) AS n, embedding[0] AS first, array_max(embedding) AS top, CAST(array_position(embedding, array_max(embedding)) AS BIGINT) AS at FROM {embeddings}",
        "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, embedding[1] AS first, list_max(embedding) AS top, CAST(list_position(embedding, list_max(embedding)) AS BIGINT) AS at FROM {embeddings}",
    ),
    "array_unnest": (
        "SELECT n_regionkey, name FROM (SELECT n_regionkey, sort_array(collect_list(n_name)) AS names FROM {nation} GROUP BY n_regionkey) LATERAL VIEW explode(names) t AS name",
        "SELECT n_regionkey, unnest(names) AS name FROM (SELECT n_regionkey, list_sort(list(n_name)) AS names FROM {nation} GROUP BY n_regionkey)",
    ),
    "array_higher_order": (
        "SELECT vec_id, aggregate(transform(embedding, x -> CAST(x > 0 AS BIGINT)), 0L, (a, x) -> a + x) AS positive, CAST(size(filter(embedding, x -> x > 0.1)) AS BIGINT) AS big FROM {embeddings}",
        "SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x: CAST(x > 0 AS BIGINT))) AS BIGINT) AS positive, CAST(len(list_filter(embedding, lambda x: x > 0.1)) AS BIGINT) AS big FROM {embeddings}",
    ),
    "map_ops": (
        "SELECT n_nationkey, map(n_name, n_regionkey)[n_name] AS v, array_join(map_keys(map(n_name, n_regionkey)), ',') AS ks FROM {nation}",
        "SELECT n_nationkey, map([n_name], [n_regionkey])[n_name] AS v, array_to_string(map_keys(map([n_name], [n_regionkey])), ',') AS ks FROM {nation}",
    ),
    "json_extract": ("SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM {events}", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM {events}"),
    # joins
    "join_inner": "SELECT o_orderkey, c_name, o_totalprice FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE c_acctbal > 5000",
    "join_left": "SELECT c_custkey, o_orderkey FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey AND o_orderstatus = 'P'",
    "join_right": "SELECT n_name, s_suppkey FROM {supplier} RIGHT JOIN {nation} ON s_nationkey = n_nationkey AND s_acctbal > 0",
    "join_full": "SELECT c_custkey, s_suppkey FROM (SELECT * FROM {customer} WHERE c_custkey < 80) c FULL JOIN (SELECT * FROM {supplier} WHERE s_suppkey > 40) s ON c_custkey = s_suppkey",
    "join_cross": "SELECT r.r_name, n.n_name FROM {region} r CROSS JOIN {nation} n",
    "join_self": "SELECT a.n_name AS left_name, b.n_name AS right_name FROM {nation} a JOIN {nation} b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
    "join_multiway": f"""SELECT r_name, n_name, count(*) AS n, {_REVENUE} AS revenue FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
        JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey GROUP BY r_name, n_name""",
    "join_using": "SELECT k, r_name, n FROM (SELECT r_regionkey AS k, r_name FROM {region}) a JOIN (SELECT n_regionkey AS k, count(*) AS n FROM {nation} GROUP BY n_regionkey) b USING (k)",
    "join_natural": "SELECT k, a, b FROM (SELECT n_nationkey AS k, n_name AS a FROM {nation}) x NATURAL JOIN (SELECT s_nationkey AS k, s_name AS b FROM {supplier}) y",
    "join_semi": "SELECT c_custkey, c_name FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 200000)",
    "join_anti": "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 100000)",
    "not_in_null_aware": "SELECT n_nationkey FROM {nation} WHERE n_nationkey NOT IN (SELECT CASE WHEN s_suppkey > 0 THEN s_nationkey END FROM {supplier} WHERE s_acctbal < 3000)",
    "not_in_with_nulls": "SELECT n_nationkey FROM {nation} WHERE n_nationkey NOT IN (SELECT CASE WHEN s_suppkey > 3 THEN s_nationkey END FROM {supplier})",
    "join_theta": "SELECT a.n_nationkey AS x, b.n_nationkey AS y FROM {nation} a JOIN {nation} b ON a.n_nationkey + 3 < b.n_nationkey AND a.n_regionkey <> b.n_regionkey",
    # Spark forgets the order above the limit of a correlated sub-query when a column of it is not in the sub-query's result.
    "join_lateral": (
        "SELECT c_custkey, o.o_orderkey FROM {customer}, LATERAL (SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) o",
        "SELECT c_custkey, o.o_orderkey FROM {customer}, LATERAL (SELECT o_orderkey FROM {orders} WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) o",
    ),
    # aggregation
    "agg_global": f"SELECT count(*) AS n, {_money('o_totalprice')} AS total, min(o_totalprice) AS least, max(o_totalprice) AS most, {_avg('o_totalprice')} AS mean FROM {{orders}}",
    "agg_empty": "SELECT count(*) AS n, max(o_orderkey) AS m FROM {orders} WHERE o_orderkey < 0",
    "agg_group": f"SELECT o_orderstatus, o_orderpriority, count(*) AS n, {_money('o_totalprice')} AS total FROM {{orders}} GROUP BY o_orderstatus, o_orderpriority",
    "agg_having": f"SELECT o_custkey, count(*) AS n, {_money('o_totalprice')} AS total FROM {{orders}} GROUP BY o_custkey HAVING count(*) > 12",
    "agg_group_all": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY ALL",
    "agg_distinct": "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS supps, count(*) AS n FROM {lineitem} GROUP BY l_returnflag",
    "agg_filter_clause": "SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_totalprice > 100000) AS big FROM {orders} GROUP BY o_custkey",
    "agg_rollup": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "agg_cube": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)",
    "agg_grouping_sets": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    "agg_stats": (
        "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, median(l_quantity) AS med FROM {lineitem} GROUP BY l_returnflag",
        "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, median(l_quantity) AS med FROM {lineitem} GROUP BY l_returnflag",
    ),
    "agg_percentile": ("SELECT o_orderstatus, round(percentile(o_totalprice, 0.9), 4) AS p90 FROM {orders} GROUP BY o_orderstatus", "SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM {orders} GROUP BY o_orderstatus"),
    "agg_collect": (
        "SELECT n_regionkey, array_join(sort_array(collect_list(n_name)), '|') AS names, CAST(size(collect_set(n_regionkey)) AS BIGINT) AS k FROM {nation} GROUP BY n_regionkey",
        "SELECT n_regionkey, array_to_string(list_sort(list(n_name)), '|') AS names, CAST(len(list(DISTINCT n_regionkey)) AS BIGINT) AS k FROM {nation} GROUP BY n_regionkey",
    ),
    "agg_string": ("SELECT n_regionkey, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS names FROM {nation} GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM {nation} GROUP BY n_regionkey"),
    "agg_max_by": ("SELECT o_custkey, max_by(o_orderkey, struct(o_totalprice, o_orderkey)) AS top, min_by(o_orderkey, struct(o_totalprice, o_orderkey)) AS low FROM {orders} GROUP BY o_custkey", "SELECT o_custkey, arg_max(o_orderkey, row(o_totalprice, o_orderkey)) AS top, arg_min(o_orderkey, row(o_totalprice, o_orderkey)) AS low FROM {orders} GROUP BY o_custkey"),
    "agg_bool": "SELECT o_custkey, bool_and(o_totalprice > 1000) AS every, bool_or(o_orderstatus = 'P') AS some FROM {orders} GROUP BY o_custkey",
    "agg_pivot": (
        "SELECT * FROM (SELECT o_orderpriority, o_orderstatus FROM {orders}) PIVOT (count(*) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))",
        "SELECT o_orderpriority, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS f, nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS o, nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS p FROM {orders} GROUP BY o_orderpriority",
    ),
    "column_max": "SELECT max(o_orderdate) AS hwm FROM {orders}",
    # windows
    "win_row_number": "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS r FROM {orders}",
    "win_rank_dense": "SELECT l_orderkey, l_linenumber, CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS BIGINT) AS r, CAST(dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS BIGINT) AS d FROM {lineitem}",
    "win_ntile_pct": "SELECT c_custkey, CAST(ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS BIGINT) AS q, percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS p, cume_dist() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS cd FROM {customer}",
    "win_lag_lead": "SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, lead(event_id, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM {events}",
    "win_first_last": "SELECT event_id, first_value(event_id) OVER w AS f, last_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l, nth_value(event_id, 2) OVER w AS second FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "win_ignore_nulls": (
        "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END) IGNORE NULLS OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_buy FROM {events}",
        "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_buy FROM {events}",
    ),
    "win_running_sum": "SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS total FROM {orders}",
    "win_range_frame": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW) AS n FROM {events}",
    "win_moving_avg": "SELECT event_id, round(CAST(sum(CAST(value AS DECIMAL(18,6))) OVER w AS DOUBLE) / count(value) OVER w, 6) AS m FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING)",
    "win_qualify": (
        "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM {orders}) WHERE r = 1",
        "SELECT o_custkey, o_orderkey FROM {orders} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1",
    ),
    # order and limit
    "sort_multi_nulls": "SELECT c_custkey, o_orderkey FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey AND o_totalprice > 200000 ORDER BY o_orderkey DESC NULLS LAST, c_custkey LIMIT 500",
    "limit_offset": "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 20",
    "topk": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM {lineitem} ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 100",
    "limit_zero": "SELECT o_orderkey FROM {orders} LIMIT 0",
    # set operations
    "set_union_all": "SELECT c_nationkey AS k FROM {customer} UNION ALL SELECT s_nationkey FROM {supplier}",
    "set_union": "SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}",
    "set_intersect": "SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier} WHERE s_acctbal > 2000",
    "set_intersect_all": "SELECT c_nationkey AS k FROM {customer} INTERSECT ALL SELECT s_nationkey FROM {supplier}",
    "set_except": "SELECT n_nationkey AS k FROM {nation} EXCEPT SELECT s_nationkey FROM {supplier} WHERE s_acctbal > 2000",
    "set_except_all": "SELECT c_nationkey AS k FROM {customer} EXCEPT ALL SELECT s_nationkey FROM {supplier}",
    # sub-queries
    "cte_chain": f"WITH big AS (SELECT * FROM {{orders}} WHERE o_totalprice > 150000), per AS (SELECT o_custkey, count(*) AS n, {_money('o_totalprice')} AS t FROM big GROUP BY o_custkey) SELECT c_name, n, t FROM per JOIN {{customer}} ON o_custkey = c_custkey WHERE n > 2",
    "recursive_cte": "WITH RECURSIVE r(n, f) AS (SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM r WHERE n < 15) SELECT n, f FROM r",
    "subq_scalar": "SELECT o_orderkey FROM {orders} WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9 FROM {orders})",
    "subq_correlated": "SELECT p_partkey FROM {part} p WHERE p_retailprice >= (SELECT max(q.p_retailprice) FROM {part} q WHERE q.p_brand = p.p_brand)",
    "subq_exists": "SELECT s_suppkey FROM {supplier} WHERE EXISTS (SELECT 1 FROM {lineitem} WHERE l_suppkey = s_suppkey AND l_quantity = 50) AND s_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey < 3)",
    # functions
    "fn_string": (
        "SELECT c_custkey, upper(c_name) AS u, lower(c_name) AS l, CAST(length(c_name) AS BIGINT) AS n, substring(c_name, 2, 5) AS sub, left(c_name, 3) AS lft, right(c_name, 3) AS rgt, lpad(c_mktsegment, 12, '*') AS lp, concat_ws('-', c_name, c_mktsegment) AS cw, replace(c_name, 'C', 'k') AS rep, reverse(c_name) AS rev, CAST(instr(c_name, '0') AS BIGINT) AS pos, regexp_extract(c_name, '([0-9]+)', 1) AS dig, regexp_replace(c_name, '[0-9]', 'x') AS rx, split_part(c_name, '#', 2) AS sp, md5(c_name) AS h, startswith(c_name, 'Cust') AS sw, trim('  a ') AS tr, translate(c_name, 'abc', 'xyz') AS tl, CAST(levenshtein(c_name, c_mktsegment) AS BIGINT) AS lev FROM {customer}",
        "SELECT c_custkey, upper(c_name) AS u, lower(c_name) AS l, CAST(length(c_name) AS BIGINT) AS n, substring(c_name, 2, 5) AS sub, left(c_name, 3) AS lft, right(c_name, 3) AS rgt, lpad(c_mktsegment, 12, '*') AS lp, concat_ws('-', c_name, c_mktsegment) AS cw, replace(c_name, 'C', 'k') AS rep, reverse(c_name) AS rev, CAST(strpos(c_name, '0') AS BIGINT) AS pos, regexp_extract(c_name, '([0-9]+)', 1) AS dig, regexp_replace(c_name, '[0-9]', 'x', 'g') AS rx, split_part(c_name, '#', 2) AS sp, md5(c_name) AS h, starts_with(c_name, 'Cust') AS sw, trim('  a ') AS tr, translate(c_name, 'abc', 'xyz') AS tl, CAST(levenshtein(c_name, c_mktsegment) AS BIGINT) AS lev FROM {customer}",
    ),
    "fn_math": (
        "SELECT l_orderkey, l_linenumber, abs(-l_quantity) AS a, CAST(ceil(l_extendedprice) AS BIGINT) AS c, CAST(floor(l_extendedprice) AS BIGINT) AS f, sqrt(l_quantity) AS s, CAST(l_orderkey % 7 AS BIGINT) AS m, CAST(sign(l_discount - 0.05) AS DOUBLE) AS sg, greatest(l_quantity, 10.0D) AS g, least(l_tax, l_discount) AS le, CAST(l_orderkey DIV 3 AS BIGINT) AS dv, CAST(l_orderkey & 5 AS BIGINT) AS ba, CAST(l_orderkey ^ 3 AS BIGINT) AS bx FROM {lineitem}",
        "SELECT l_orderkey, l_linenumber, abs(-l_quantity) AS a, CAST(ceil(l_extendedprice) AS BIGINT) AS c, CAST(floor(l_extendedprice) AS BIGINT) AS f, sqrt(l_quantity) AS s, CAST(l_orderkey % 7 AS BIGINT) AS m, CAST(sign(l_discount - 0.05) AS DOUBLE) AS sg, greatest(l_quantity, 10.0) AS g, least(l_tax, l_discount) AS le, CAST(l_orderkey // 3 AS BIGINT) AS dv, CAST(l_orderkey & 5 AS BIGINT) AS ba, CAST(xor(l_orderkey, 3) AS BIGINT) AS bx FROM {lineitem}",
    ),
    "fn_date": (
        "SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS BIGINT) AS y, CAST(quarter(o_orderdate) AS BIGINT) AS q, CAST(extract(month FROM o_orderdate) AS BIGINT) AS m, CAST(dayofyear(o_orderdate) AS BIGINT) AS doy, CAST(extract(week FROM o_orderdate) AS BIGINT) AS w, CAST(dayofweek(o_orderdate) - 1 AS BIGINT) AS dow, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP_NTZ) AS mon, CAST(o_orderdate AS DATE) AS d, CAST(datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01') AS BIGINT) AS days, last_day(CAST(o_orderdate AS DATE)) AS ld, date_format(o_orderdate, 'yyyy-MM-dd') AS s, o_orderdate + INTERVAL 90 MINUTE AS later FROM {orders}",
        "SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS BIGINT) AS y, CAST(extract(quarter FROM o_orderdate) AS BIGINT) AS q, CAST(extract(month FROM o_orderdate) AS BIGINT) AS m, CAST(extract(doy FROM o_orderdate) AS BIGINT) AS doy, CAST(extract(week FROM o_orderdate) AS BIGINT) AS w, CAST(extract(dow FROM o_orderdate) AS BIGINT) AS dow, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS mon, CAST(o_orderdate AS DATE) AS d, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days, last_day(CAST(o_orderdate AS DATE)) AS ld, strftime(o_orderdate, '%Y-%m-%d') AS s, o_orderdate + INTERVAL 90 MINUTE AS later FROM {orders}",
    ),
    "fn_cond": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS seg, if(c_nationkey > 10, 1, 0) AS flag, ifnull(NULL, c_nationkey) AS k FROM {customer}",
    "fn_cast_try": (
        "SELECT c_custkey, try_cast(c_name AS INT) AS bad, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) AS txt, CAST(c_nationkey AS STRING) AS s, try_cast(CAST(c_custkey AS STRING) AS BIGINT) AS back FROM {customer}",
        "SELECT c_custkey, try_cast(c_name AS INT) AS bad, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS txt, CAST(c_nationkey AS VARCHAR) AS s, try_cast(CAST(c_custkey AS VARCHAR) AS BIGINT) AS back FROM {customer}",
    ),
    # time windows
    "win_tumbling": ("SELECT window(ts, '1 hour').start AS w, event_type, count(*) AS n FROM {events} GROUP BY window(ts, '1 hour'), event_type", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type, count(*) AS n FROM {events} GROUP BY 1, 2"),
    "win_sliding": (
        "SELECT window(ts, '2 hours', '1 hour').start AS w, count(*) AS n FROM {events} GROUP BY window(ts, '2 hours', '1 hour')",
        "SELECT w, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) - k * INTERVAL 1 HOUR AS w FROM {events}, (VALUES (0), (1)) v(k)) GROUP BY w",
    ),
    "win_session": (
        "SELECT user_id, session_window(ts, '2 hours').start AS s, count(*) AS n FROM {events} GROUP BY user_id, session_window(ts, '2 hours')",
        """SELECT user_id, min(ts) AS s, count(*) AS n FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g
           FROM (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR > ts THEN 0 ELSE 1 END AS fresh FROM {events})) GROUP BY user_id, g""",
    ),
}


def _run(text: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        names = sorted(set(re.findall(r"\{(\w+)\}", text)))
        return spark.sql(text, **{n: spark.read.parquet(f"{sf}/{n}.parquet") for n in names})

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(text if isinstance(text, str) else text[0]) for name, text in SQL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: re.sub(r"\{(\w+)\}", r"\1", text if isinstance(text, str) else text[1]) for name, text in SQL.items()}
