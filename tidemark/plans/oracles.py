"""DuckDB oracle SQL for the driver-check queries (see ``checks``).

Written independently of the Spark code: it restates the reference's staging
SQL (renames, the customer_profile CTE query, the profile ⟕ orders join) in
DuckDB's dialect, builds the event JSON text by string concatenation, and
expresses merges as ``target-only rows UNION ALL deduplicated staging``.
"""

from __future__ import annotations

from .checks import (
    CHECK_EVENT_TIME,
    EARLY_BALANCE,
    FIRST_ORDERS_UNTIL,
    NEW_FROM,
    OLD_UNTIL,
    RECENT_FROM,
    SOURCE_PARTITION_KEYS,
    SPLITS,
    STALE,
)
from .spec import JOB_ORDER, SPECS

MONEY = "DECIMAL(15,2)"

# Source columns present in the check data (see FIXTURES.md), reference order.
PRESENT = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "partsupp": ("ps_partkey", "ps_suppkey", "ps_availqty", "ps_supplycost"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ),
}
COPY_KINDS = {
    "orders": {"orderdate": "ts"},
    "lineitem": {"shipdate": "ts"},
    "partsupp": {"supplycost": "money"},
}
CO_KINDS = {
    "order_aggregate_identifier": "id", "customer_aggregate_identifier": "id",
    "totalprice": "money", "orderdate": "date",
}
TOTALS = (
    "total_purchase_order", "total_net_lineitem", "total_gross_lineitem",
    "total_discount_lineitem", "total_tax_lineitem",
)
PROFILE_KINDS = {"customer_aggregate_identifier": "id", "account_balance": "money", **{t: "money" for t in TOTALS}}
EVENT_KINDS = {"customer_aggregate_identifier": "id"}


def agg_id(col: str) -> str:
    return f"unhex(md5(lpad(bin(CAST({col} AS BIGINT)), 64, '0')))"


def money(col: str) -> str:
    return f"CAST({col} AS {MONEY})"


def present_sql(sql: str, kinds: dict[str, str]) -> str:
    """Apply the check conversions to the named columns of ``sql``."""
    conv = {
        "id": "lower(hex({c}))",
        "money": "CAST({c} AS DOUBLE)",
        "date": "strftime({c}, '%Y-%m-%d')",
        "ts": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    }
    if not kinds:
        return sql
    repl = ", ".join(f"{conv[k].format(c=c)} AS {c}" for c, k in kinds.items())
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) q"


def _strip(col: str) -> str:
    return col.split("_", 1)[1]


def copy_sql(table: str, where: str = "", source: str | None = None) -> str:
    cols = ", ".join(f"{c} AS {_strip(c)}" for c in PRESENT[table])
    return f"SELECT {cols} FROM {source or table} {where}"


def copy_columns(table: str) -> list[str]:
    return [_strip(c) for c in PRESENT[table]]


def standin_sql(where: str = "") -> str:
    inner = (
        "SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, "
        "CAST(SUM(l_quantity) AS INTEGER) AS ps_availqty, "
        f"{money('MIN(l_extendedprice)')} AS ps_supplycost "
        f"FROM lineitem {where} GROUP BY l_partkey, l_suppkey"
    )
    return copy_sql("partsupp", source=f"({inner}) ps")


def customer_orders_sql(where: str = "") -> str:
    return f"""SELECT o_orderkey AS orderkey,
       {agg_id('o_orderkey')} AS order_aggregate_identifier,
       {agg_id('o_custkey')} AS customer_aggregate_identifier,
       o_orderstatus AS orderstatus,
       {money('o_totalprice')} AS totalprice,
       CAST(o_orderdate AS DATE) AS orderdate,
       o_orderpriority AS orderpriority
  FROM orders {where}"""


CO_COLUMNS = [
    "orderkey", "order_aggregate_identifier", "customer_aggregate_identifier", "orderstatus",
    "totalprice", "orderdate", "orderpriority",
]


def profile_sql(where: str = "") -> str:
    """The profile by its meaning: lines summed per order, orders (with their
    lines' sums) per customer, one row per customer with zeros where none."""
    lines = ", ".join(
        f"SUM({e}) AS {n}"
        for n, e in (("gross", money("l_extendedprice")), ("discount", money("l_discount")), ("tax", money("l_tax")))
    )
    per_order = f"SELECT l_orderkey, {lines} FROM lineitem GROUP BY l_orderkey"
    owned = f"SELECT o_orderkey, o_custkey, {money('o_totalprice')} AS price FROM orders {where}"
    spent = (
        "SELECT o_custkey, SUM(price) AS bought, SUM(gross) AS gross, SUM(discount) AS discount, SUM(tax) AS tax "
        f"FROM ({owned}) own LEFT JOIN ({per_order}) line ON o_orderkey = l_orderkey GROUP BY o_custkey"
    )
    zero = lambda e: money(f"COALESCE({e}, 0)")
    return f"""SELECT c_custkey AS custkey, {agg_id('c_custkey')} AS customer_aggregate_identifier, c_name AS name,
       (SELECT min(n_name) FROM nation WHERE n_nationkey = c_nationkey) AS country,
       {money('c_acctbal')} AS account_balance, {zero('bought')} AS total_purchase_order,
       {zero('gross - discount + tax')} AS total_net_lineitem, {zero('gross')} AS total_gross_lineitem,
       {zero('discount')} AS total_discount_lineitem, {zero('tax')} AS total_tax_lineitem,
       c_mktsegment AS market_segment
  FROM customer LEFT JOIN ({spent}) spent ON o_custkey = c_custkey"""


PROFILE_COLUMNS = ["custkey", "customer_aggregate_identifier", "name", "country", "account_balance", *TOTALS, "market_segment"]


P11_PROFILE = ["name", "country", "account_balance", *TOTALS, "market_segment"]
P11_ORDER = ["orderstatus", "totalprice", "orderdate", "orderpriority"]


def profile_orders_sql(where: str = "") -> str:
    """Profile LEFT JOIN customer orders on the customer identifier."""
    prof = ", ".join(f"cp.{c}" for c in P11_PROFILE)
    ords = ", ".join(f"p.{c}" for c in P11_ORDER)
    return f"""SELECT cp.customer_aggregate_identifier, p.order_aggregate_identifier, cp.custkey, {prof}, {ords}
  FROM ({profile_sql(where)}) cp
  LEFT JOIN ({customer_orders_sql(where)}) p
    ON cp.customer_aggregate_identifier = p.customer_aggregate_identifier"""


PROFILE_ORDERS_KINDS = {**PROFILE_KINDS, **CO_KINDS}


def _jfield(key: str, expr: str, kind: str) -> str:
    value = {
        "str": f"CAST(to_json({expr}) AS VARCHAR)",
        "num": f"CAST({expr} AS VARCHAR)",
        "b64": f"'\"' || base64({expr}) || '\"'",
        "date": f"'\"' || strftime({expr}, '%Y-%m-%d') || '\"'",
        "raw": expr,
    }[kind]
    return f"CASE WHEN {expr} IS NOT NULL THEN '\"{key}\":' || {value} END"


def _jobject(fields: list[tuple[str, str]]) -> str:
    return "'{' || concat_ws(',', " + ", ".join(_jfield(k, k, kind) for k, kind in fields) + ") || '}'"


ORDER_JSON = [
    ("order_aggregate_identifier", "b64"), ("orderstatus", "str"), ("totalprice", "num"),
    ("orderdate", "date"), ("orderpriority", "str"),
]
PROFILE_JSON = [
    ("customer_aggregate_identifier", "b64"), ("name", "str"), ("country", "str"),
    ("account_balance", "num"), *[(t, "num") for t in TOTALS], ("market_segment", "str"),
    ("customer_order", "raw"),
]


def events_sql(where: str = "") -> str:
    """Encoded events with the reference's double JSON encoding."""
    group = ", ".join(["customer_aggregate_identifier", "custkey", *P11_PROFILE])
    return f"""WITH r AS ({profile_orders_sql(where)}),
o AS (SELECT r.*, {_jobject(ORDER_JSON)} AS otext FROM r),
l AS (SELECT {group},
             CAST(to_json(list(otext ORDER BY order_aggregate_identifier NULLS FIRST, otext)) AS VARCHAR) AS customer_order
        FROM o GROUP BY {group}),
p AS (SELECT l.*, {_jobject(PROFILE_JSON)} AS ptext FROM l)
SELECT customer_aggregate_identifier, custkey,
       CAST(to_json(list(ptext ORDER BY ptext)) AS VARCHAR) AS event_parameters,
       'MigEvent' AS event_type,
       CAST({CHECK_EVENT_TIME} AS BIGINT) AS event_timestamp
  FROM p GROUP BY customer_aggregate_identifier, custkey"""


EVENT_COLUMNS = ["customer_aggregate_identifier", "custkey", "event_parameters", "event_type", "event_timestamp"]


def nested_flat_sql() -> str:
    """E2 parsed back: one row per (customer, order) of the nested document."""
    prof = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ("account_balance", *TOTALS) else c for c in P11_PROFILE)
    return f"""SELECT hex(customer_aggregate_identifier) AS customer_aggregate_identifier, {prof},
       hex(order_aggregate_identifier) AS order_aggregate_identifier, orderstatus,
       CAST(totalprice AS DOUBLE) AS totalprice, strftime(orderdate, '%Y-%m-%d') AS orderdate, orderpriority
  FROM ({profile_orders_sql()}) r"""


def dedup_sql(sql: str, keys: list[str], columns: list[str]) -> str:
    others = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in others) or "1"
    cols = ", ".join(columns)
    return (
        f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {order}) AS _rn FROM ({sql}) d) WHERE _rn = 1"
    )


def upsert_sql(target: str, staging: str, keys: list[str], columns: list[str]) -> str:
    cols = ", ".join(columns)
    match = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"""WITH tgt AS ({target}), stg AS ({dedup_sql(staging, keys, columns)})
SELECT {cols} FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE {match})
UNION ALL
SELECT {cols} FROM stg"""


def _before(col: str) -> str:
    return f"WHERE {col} < DATE '{OLD_UNTIL}'"


def _from(col: str) -> str:
    return f"WHERE {col} >= DATE '{NEW_FROM}'"


def _replace(sql: str, **values: str) -> str:
    repl = ", ".join(f"{v} AS {k}" for k, v in values.items())
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) x"


def _only(sql: str, columns: list[str]) -> str:
    return f"SELECT {', '.join(columns)} FROM ({sql}) x"


RECENT = f"(SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '{RECENT_FROM}')"
EARLY = f"(SELECT c_custkey FROM customer WHERE c_acctbal < {EARLY_BALANCE})"


def _where(sql: str, condition: str) -> str:
    return f"SELECT * FROM ({sql}) w WHERE {condition}"


def upsert_scenario_sql(table: str) -> str:
    if table in SPLITS:
        cur = copy_sql(table)
        by, below, since = SPLITS[table]
        text = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
        stale = {STALE[table]: "CAST(0.0 AS DOUBLE)"} if table in STALE else {"name": "lower(name)"}
        old = _replace(_where(cur, f"{by} < {text(below)}"), **stale)
        key = copy_columns(table)[0]
        return upsert_sql(old, _where(cur, f"{by} >= {text(since)}"), [key], copy_columns(table))
    if table == "customer":
        cur = copy_sql("customer")
        old = _replace(_where(cur, f"acctbal < {EARLY_BALANCE}"), acctbal="CAST(0.0 AS DOUBLE)")
        return upsert_sql(old, _where(cur, f"custkey IN {RECENT}"), ["custkey"], copy_columns("customer"))
    if table == "partsupp":
        sql = upsert_sql(
            standin_sql(_before("l_shipdate")), standin_sql(_from("l_shipdate")), ["partkey", "suppkey"], copy_columns("partsupp")
        )
        return present_sql(sql, COPY_KINDS["partsupp"])
    if table == "orders":
        old = _replace(copy_sql("orders", _before("o_orderdate")), orderstatus="'O'")
        sql = upsert_sql(old, copy_sql("orders", _from("o_orderdate")), ["orderkey"], copy_columns("orders"))
        return present_sql(sql, COPY_KINDS["orders"])
    if table == "lineitem":
        cols = copy_columns("lineitem")
        keys = ["orderkey", "linenumber"]
        old = _replace(dedup_sql(copy_sql("lineitem", _before("l_shipdate")), keys, cols), linestatus="'O'")
        sql = upsert_sql(old, copy_sql("lineitem", _from("l_shipdate")), keys, cols)
        return present_sql(sql, COPY_KINDS["lineitem"])
    spec = SPECS[table]
    if table == "customer_orders":
        cols = [c for c in CO_COLUMNS if c not in spec.target_drops]
        old = _only(_replace(customer_orders_sql(_before("o_orderdate")), orderstatus="'O'"), cols)
        new = customer_orders_sql(_from("o_orderdate"))
        kinds = CO_KINDS
    elif table == "customer_profile":
        cols = [c for c in PROFILE_COLUMNS if c not in spec.target_drops]
        old = _only(_where(profile_sql(_before("o_orderdate")), f"custkey IN {EARLY}"), cols)
        new = _where(profile_sql(), f"custkey IN {RECENT}")
        kinds = PROFILE_KINDS
    elif table == "customer_event":
        cols = [c for c in EVENT_COLUMNS if c not in spec.target_drops]
        first = f"WHERE o_orderdate < DATE '{FIRST_ORDERS_UNTIL}'"
        old = _only(_where(events_sql(first), f"custkey IN {EARLY}"), cols)
        new = _where(events_sql(), f"custkey IN {RECENT}")
        kinds = EVENT_KINDS
    else:
        raise KeyError(table)
    return present_sql(upsert_sql(old, new, list(spec.merge_keys), cols), kinds)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def chunk_counts_sql(table: str, key: str, n: int) -> str:
    return f"""WITH b AS (SELECT CAST(min({key}) AS BIGINT) AS lo, CAST(max({key}) AS BIGINT) AS hi FROM {table}),
p AS (SELECT lo, hi, greatest(1, least({n}, hi - lo)) AS n FROM b),
s AS (SELECT lo, n, CASE WHEN n > 1 THEN (hi - lo) // n ELSE greatest(hi - lo, 1) END AS stride FROM p)
SELECT CAST(COALESCE(least((SELECT n FROM s) - 1,
                           greatest(0, (CAST({key} AS BIGINT) - (SELECT lo FROM s)) // (SELECT stride FROM s))), 0)
            AS INTEGER) AS chunk,
       count(*) AS rows
  FROM {table}
 GROUP BY 1"""


def even_chunks_sql(table: str, key: str, n: int) -> str:
    """Cut points at exact ranks: chunk i ends with the key at rank ceil(i / n x rows)."""
    return f"""WITH r AS MATERIALIZED (SELECT k, row_number() OVER (ORDER BY k) AS rn, count(*) OVER () AS rows, max(k) OVER () AS hi
  FROM (SELECT CAST({key} AS BIGINT) AS k FROM {table}) x),
c AS MATERIALIZED (SELECT DISTINCT r.k + 1 AS cut FROM r JOIN range(1, {n}) t(i) ON r.rn = ceil(CAST(i AS DOUBLE) / {n} * r.rows) WHERE r.k < r.hi),
k AS MATERIALIZED (SELECT k, count(*) AS rows FROM r GROUP BY k),
p AS (SELECT k.k, any_value(k.rows) AS rows, count(c.cut) AS chunk FROM k LEFT JOIN c ON c.cut <= k.k GROUP BY k.k)
SELECT CAST(chunk AS INTEGER) AS chunk, min(k) AS lower, max(k) AS upper, CAST(sum(rows) AS BIGINT) AS rows FROM p GROUP BY chunk"""


def last_arrival_sql() -> str:
    """The last line of each key in the file's order."""
    cols, keys = copy_columns("lineitem"), "orderkey, linenumber"
    names = ", ".join(f"{c} AS {_strip(c)}" for c in PRESENT["lineitem"])
    numbered = f"SELECT {names}, row_number() OVER () AS _seq FROM lineitem"
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY _seq DESC) AS _rn "
        f"FROM ({numbered}) n) d WHERE _rn = 1"
    )


# The longest text that a column of the DDL takes, of the columns in the check data.
DDL_LENGTHS = {
    "customer_orders": {"orderstatus": 2, "orderpriority": 10},
    "customer_profile": {"name": 100, "country": 50, "market_segment": 50},
}


def _breaks(table: str, columns: list[str]) -> dict[str, str]:
    nulls = {f"{c}: null": f"{c} IS NULL" for c in columns}
    return nulls | {f"{c}: length": f"coalesce(length({c}) > {n}, false)" for c, n in DDL_LENGTHS[table].items()}


def conform_counts_sql() -> str:
    parts = []
    for table, sql, columns in (("customer_orders", customer_orders_sql(), CO_COLUMNS), ("customer_profile", profile_sql(), PROFILE_COLUMNS)):
        rules = _breaks(table, columns)
        any_of = " OR ".join(f"({c})" for c in rules.values())
        kinds = {"fitting": f"NOT ({any_of})", "rejected": any_of, **rules}
        counted = [
            f"SELECT '{table}' AS table_name, '{kind}' AS kind, count(*) FILTER (WHERE {condition}) AS rows FROM ({sql}) x" for kind, condition in kinds.items()
        ]
        parts.append(f"SELECT * FROM ({_union(counted)}) c WHERE rows > 0 OR kind IN ('fitting', 'rejected')")
    return _union(parts)


def fitting_orders_sql() -> str:
    any_of = " OR ".join(f"({c})" for c in _breaks("customer_orders", CO_COLUMNS).values())
    return _where(customer_orders_sql(), f"NOT ({any_of})")


def job_sql(table: str) -> str:
    """A job's target after its first (and any further) run: staging, one row a key, target columns."""
    spec = SPECS[table]
    staged, columns, kinds = {
        "customer_orders": (customer_orders_sql(), CO_COLUMNS, CO_KINDS),
        "customer_profile": (profile_sql(), PROFILE_COLUMNS, PROFILE_KINDS),
        "customer_event": (events_sql(), EVENT_COLUMNS, EVENT_KINDS),
    }.get(table) or (
        standin_sql() if table == "partsupp" else copy_sql(table), copy_columns(table), COPY_KINDS.get(table, {})
    )
    kept = [c for c in columns if c not in spec.target_drops]
    kinds = {c: k for c, k in kinds.items() if c in kept}
    return present_sql(dedup_sql(staged, list(spec.merge_keys), kept), kinds)


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        sql[f"stage_{t}"] = present_sql(copy_sql(t), COPY_KINDS.get(t, {}))
    sql["stage_partsupp"] = present_sql(standin_sql(), COPY_KINDS["partsupp"])
    sql["customer_orders"] = present_sql(customer_orders_sql(), CO_KINDS)
    sql["order_totals"] = (
        f"SELECT o_custkey, CAST(CAST(SUM({money('o_totalprice')}) AS {MONEY}) AS DOUBLE) AS total_purchase_order "
        "FROM orders GROUP BY o_custkey"
    )
    line = {
        "total_net_lineitem": f"{money('l.l_extendedprice')} - {money('l.l_discount')} + {money('l.l_tax')}",
        "total_gross_lineitem": money("l.l_extendedprice"),
        "total_discount_lineitem": money("l.l_discount"),
        "total_tax_lineitem": money("l.l_tax"),
    }
    sums = ", ".join(f"CAST(CAST(SUM({e}) AS {MONEY}) AS DOUBLE) AS {n}" for n, e in line.items())
    sql["lineitem_totals"] = (
        f"SELECT o.o_custkey, {sums} FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY o.o_custkey"
    )
    sql["customer_country"] = (
        "SELECT c.c_custkey AS custkey, n.n_name AS country FROM customer c "
        "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"
    )
    sql["customer_profile"] = present_sql(profile_sql(), PROFILE_KINDS)
    sql["profile_orders"] = present_sql(profile_orders_sql(), PROFILE_ORDERS_KINDS)
    sql["customer_event"] = present_sql(events_sql(), EVENT_KINDS)
    sql["customer_event_nested"] = nested_flat_sql()
    sql["pk_bounds"] = _union(
        [
            f"SELECT '{t}' AS table_name, CAST(min({k}) AS BIGINT) AS min_key, CAST(max({k}) AS BIGINT) AS max_key FROM {t}"
            for t, k in SOURCE_PARTITION_KEYS
        ]
    )
    sql["chunk_counts_orders"] = chunk_counts_sql("orders", "o_orderkey", SPECS["orders"].read_partitions)
    counts = [f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem")]
    counts += [
        f"SELECT 'partsupp' AS table_name, count(*) AS rows FROM ({standin_sql()}) x",
        f"SELECT 'customer_orders' AS table_name, count(*) AS rows FROM ({customer_orders_sql()}) x",
        f"SELECT 'customer_profile' AS table_name, count(*) AS rows FROM ({profile_sql()}) x",
        f"SELECT 'customer_event' AS table_name, count(*) AS rows FROM ({events_sql()}) x",
    ]
    sql["load_counts"] = _union(counts)
    sql["upsert_duplicate_keys"] = present_sql(
        dedup_sql(copy_sql("lineitem"), ["orderkey", "linenumber"], copy_columns("lineitem")),
        COPY_KINDS["lineitem"],
    )
    for t in (
        "region", "nation", "customer", "supplier", "part", "partsupp", "orders", "lineitem",
        "customer_orders", "customer_profile", "customer_event",
    ):
        sql[f"upsert_{t}"] = upsert_scenario_sql(t)
    for t in JOB_ORDER:
        sql[f"job_{t}"] = job_sql(t)
    sql["even_chunks_lineitem"] = even_chunks_sql("lineitem", "l_orderkey", SPECS["lineitem"].read_partitions)
    sql["upsert_last_arrival"] = sql["job_lineitem_last_arrival"] = present_sql(last_arrival_sql(), COPY_KINDS["lineitem"])
    sql["conform_counts"] = conform_counts_sql()
    sql["conform_customer_orders"] = present_sql(fitting_orders_sql(), CO_KINDS)
    kept = [c for c in CO_COLUMNS if c not in SPECS["customer_orders"].target_drops]
    sql["job_customer_orders_quarantine"] = present_sql(_only(fitting_orders_sql(), kept), {c: k for c, k in CO_KINDS.items() if c in kept})
    sql["job_customer_event_copartitioned"] = sql["job_customer_event"]
    return sql
