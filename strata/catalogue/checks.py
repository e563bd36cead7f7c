"""The catalogue's queries again, as plain SQL for DuckDB.

Written from the meaning of each query, not from its Spark form: row numbers instead of
timelines, one aggregate per source and outer joins instead of the single pass, global
row numbers instead of bucketed ones.
"""

from __future__ import annotations

from strata.catalogue.queries import (
    CUT,
    CUT_WATERMARK,
    EVENT_CUT,
    EVENT_WATERMARK,
    FACT_TABLES,
    TWO_LOADS,
    WINDOW,
    cut_of,
    just_before,
)
from strata.catalogue.sources import RUN_TS, SOURCE_SYSTEM, SOURCES, TIE_BREAK, source_sql
from strata.specs import TABLES

# Column rules per table. t trim, U upper, L lower, T title, N non-negative, R range.
RULES = {
    "country": "t country_name, U country_code",
    "city": "t city_name",
    "content_type": "t content_type",
    "genre": "T genre_name",
    "artist": "t artist_name, T country",
    "device": "T device_name",
    "payment_method": "T method_name",
    "support_category": "T category_name",
    "courier": "T courier_name",
    "warehouse": "t warehouse_name",
    "subscription_plan": "t plan_name, N monthly_fee, T video_quality, N max_devices",
    "customer": "t customer_no, T first_name, T last_name, L email, t phone, T gender, U status",
    "customer_address": "t address_line, t postal_code, T address_type",
    "customer_subscription": "U status",
    "content": "t title, N duration_minutes, t language, U age_rating",
    "content_genre": "",
    "content_artist": "T role",
    "streaming_session": "N watch_duration, R0-100 completion_percentage",
    "inventory_item": "t barcode, T item_condition, U status",
    "rental": "N rental_fee, N late_fee, U status",
    "delivery": "U delivery_status",
    "payment": "N amount, U payment_type, U status",
    "review": "R1-5 rating, t review_text",
    "wishlist": "",
    "support_ticket": "U priority, U status",
    "recommendation": "t algorithm_version",
}
SPANS = {
    "customer_subscription": "end_date IS NULL OR start_date IS NULL OR start_date <= end_date",
    "streaming_session": "end_time IS NULL OR start_time IS NULL OR start_time <= end_time",
    "support_ticket": "closed_date IS NULL OR opened_date IS NULL OR opened_date <= closed_date",
}


def _title(x: str) -> str:
    words = f"regexp_extract_all(lower(trim({x})), '[a-z0-9]+|[^a-z0-9]+')"
    return f"nullif(array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ''), '')"


def _rule(rule: str, x: str) -> str:
    if rule == "t":
        return f"nullif(trim({x}), '')"
    if rule == "U":
        return f"nullif(upper(trim({x})), '')"
    if rule == "L":
        return f"nullif(lower(trim({x})), '')"
    if rule == "T":
        return _title(x)
    if rule == "N":
        return f"CASE WHEN {x} >= 0 THEN {x} END"
    low, high = rule[1:].split("-")
    return f"CASE WHEN {x} BETWEEN {low} AND {high} THEN {x} END"


def _plain(schema: str, alias: str = "") -> str:
    """Typed output columns: dates and times as text, decimals as doubles."""
    out = []
    for c in schema.split(", "):
        name, kind = c.split()
        if kind == "date" or kind.startswith("timestamp"):
            kind = "VARCHAR"
        elif kind.startswith("decimal"):
            kind = "DOUBLE"
        elif kind == "string":
            kind = "VARCHAR"
        out.append(f"CAST({alias}{name} AS {kind}) AS {name}")
    return ", ".join(out)


def _with(ctes: list[str], body: str) -> str:
    seen = list(dict.fromkeys(ctes))
    return "WITH " + ",\n".join(seen) + "\n" + body


def _changed(wm: str) -> str:
    return f"(created_at > TIMESTAMP '{wm}' OR updated_at > TIMESTAMP '{wm}')"


# --- silver -----------------------------------------------------------------------------


def _latest(table: str, rows: str) -> str:
    spec = TABLES[table]
    rules = dict(reversed(r.split()) for r in RULES[table].split(", ") if r)
    columns = ", ".join(f"{_rule(rules[c], c)} AS {c}" if c in rules else c for c in spec.business_columns)
    ties = "".join(f", {c} DESC NULLS LAST" for c in TIE_BREAK.get(table, ()))
    keys = ", ".join(spec.keys)
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
    span = f" AND ({SPANS[table]})" if table in SPANS else ""
    return f"""SELECT {columns}, created_at, updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY updated_at DESC NULLS LAST{ties}) AS rn
        FROM ({rows}) WHERE {not_null}) WHERE rn = 1{span}"""


def _s(table: str, suffix: str = "", cut: str | None = None) -> str:
    """CTE s_<table><suffix>: the silver table of all rows, or of those updated before the cut."""
    rows = source_sql(table)
    if cut is not None:
        rows = f"SELECT * FROM ({rows}) WHERE updated_at IS NULL OR updated_at < TIMESTAMP '{cut}'"
    return f"s_{table}{suffix} AS ({_latest(table, rows)})"


def _silver_schema(table: str) -> str:
    return TABLES[table].source_schema


def silver_table(table: str) -> str:
    return _with(
        [_s(table)],
        f"SELECT {_plain(_silver_schema(table))}, '{SOURCE_SYSTEM}' AS source_system FROM s_{table}",
    )


def silver_in_two_loads(table: str, cut: str) -> str:
    spec = TABLES[table]
    match = " AND ".join(f"o.{k} = n.{k}" for k in spec.keys)
    before = f"SELECT * FROM ({source_sql(table)}) WHERE greatest(created_at, updated_at) < TIMESTAMP '{cut}'"
    changed = f"""SELECT * FROM ({source_sql(table)}), mark WHERE created_at > wm OR updated_at > wm"""
    return _with(
        [
            f"old AS ({_latest(table, before)})",
            "mark AS (SELECT greatest(max(created_at), max(updated_at)) AS wm FROM old)",
            f"new AS ({_latest(table, changed)})",
            f"""merged AS (SELECT * FROM new UNION ALL
                SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE {match}))""",
        ],
        f"SELECT {_plain(_silver_schema(table))}, '{SOURCE_SYSTEM}' AS source_system FROM merged",
    )


# --- bronze -----------------------------------------------------------------------------


def _mark(table: str, where: str = "true") -> str:
    return f"""SELECT '{table}' AS table_name, CAST(coalesce(greatest(max(created_at), max(updated_at)),
        TIMESTAMP '1900-01-01 00:00:00') AS VARCHAR) AS last_watermark FROM ({source_sql(table)}) WHERE {where}"""


def _bronze_checks() -> dict[str, str]:
    payment, rental, session = TABLES["payment"], TABLES["rental"], TABLES["streaming_session"]
    events = [t for t, spec in TABLES.items() if spec.events]
    control = [
        _mark(t) if t in events[::2] else _mark(t, f"updated_at < TIMESTAMP '{CUT}'") for t in events
    ]
    window = f"created_at BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}'"
    return {
        "bronze_snapshot_lineage": f"""SELECT {_plain(payment.source_schema)},
            '{RUN_TS}' AS load_timestamp, '{SOURCE_SYSTEM}' AS source_system FROM ({source_sql("payment")})""",
        "bronze_delta_extract": f"""WITH src AS ({source_sql("rental")}),
            mark AS (SELECT greatest(max(created_at), max(updated_at)) AS wm FROM src
                     WHERE updated_at < TIMESTAMP '{CUT}')
            SELECT {_plain(rental.source_schema)} FROM src, mark WHERE created_at > wm OR updated_at > wm""",
        "table_high_water_mark": " UNION ALL ".join(_mark(t) for t in SOURCES),
        "watermark_control_upsert": " UNION ALL ".join(control),
        "backfill_window_extract": f"""SELECT {_plain(session.source_schema)}
            FROM ({source_sql("streaming_session")}) WHERE {window}""",
        # the damaged rows are all inside the window, so replacing it restores the source
        "backfill_window_replace": f"""SELECT {_plain(session.source_schema)}
            FROM ({source_sql("streaming_session")})""",
    }


def _operator_checks() -> dict[str, str]:
    text = "nullif({}(trim(raw)), '')"
    return {
        "silver_clean_text": f"""WITH t AS (SELECT CASE WHEN l_linenumber = 7 THEN '   ' ELSE
                '  ' || p_name || chr(39) || 's ' || l_returnflag || '-' || p_type || '_4k' ||
                CASE WHEN l_linenumber = 1 THEN '  ' ELSE '' END END AS raw
            FROM lineitem JOIN part ON l_partkey = p_partkey)
            SELECT raw, CAST(count(*) AS BIGINT) AS n, nullif(trim(raw), '') AS trimmed,
                {text.format('upper')} AS upper_case, {text.format('lower')} AS lower_case,
                {_title('raw')} AS title_case
            FROM t GROUP BY raw""",
        "silver_null_out_invalid": """SELECT c_custkey AS id,
            CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS non_negative,
            CASE WHEN c_custkey % 10 BETWEEN 1 AND 5 THEN c_custkey % 10 END AS in_range FROM customer""",
        "silver_dedup_latest": """SELECT * EXCLUDE (rn) REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
            FROM lineitem) WHERE rn = 1""",
        "silver_interval_filter": f"""SELECT {_plain(TABLES["rental"].source_schema)}
            FROM ({source_sql("rental")})
            WHERE return_date IS NULL OR rental_date IS NULL OR rental_date <= return_date""",
        "surrogate_keys": """SELECT k // 1000 AS band, count(*) AS n, count(*) AS n_keys, count(*) AS n_pairs,
                min(k) + 101 AS first_key, max(k) + 101 AS last_key
            FROM (SELECT unnest(range(CAST(count(*) AS BIGINT))) AS k
                  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))
            GROUP BY 1""",
    }


# --- calendar and dimensions ------------------------------------------------------------

_MONTH = """CAST(month(d) AS INT) AS month_number, monthname(d) AS month_name,
    CAST(quarter(d) AS INT) AS quarter_number, CAST(year(d) AS INT) AS year_number"""
_DAYS = """cal AS (SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date,
    CAST(day(d) AS INT) AS day_number, dayname(d) AS day_name, CAST(week(d) AS INT) AS week_number, """ + _MONTH + """
    FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2035-12-31', INTERVAL '1' DAY)) AS d))"""
_MONTHS = """months AS (SELECT CAST(strftime(d, '%Y%m') AS INT) AS month_key, """ + _MONTH + """
    FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2035-12-01', INTERVAL '1' MONTH)) AS d))"""


def _calendar_checks() -> dict[str, str]:
    paid = f"paid AS (SELECT payment_date AS paid_at FROM ({source_sql('payment')}) WHERE payment_date IS NOT NULL)"
    return {
        "dim_date": _with(
            [_DAYS, paid],
            """SELECT date_key, CAST(full_date AS VARCHAR) AS full_date, day_number, day_name, week_number,
               month_number, month_name, quarter_number, year_number, CAST(coalesce(n, 0) AS BIGINT) AS payments
               FROM cal LEFT JOIN (SELECT CAST(paid_at AS DATE) AS full_date, count(*) AS n FROM paid GROUP BY 1)
               USING (full_date)""",
        ),
        "dim_month": _with(
            [_MONTHS, paid],
            """SELECT months.*, CAST(coalesce(n, 0) AS BIGINT) AS payments FROM months
               LEFT JOIN (SELECT CAST(strftime(paid_at, '%Y%m') AS INT) AS month_key, count(*) AS n FROM paid GROUP BY 1)
               USING (month_key)""",
        ),
    }


def _key(natural: str) -> str:
    return f"row_number() OVER (ORDER BY left(md5(CAST({natural} AS VARCHAR)), 3), {natural})"


# NULL times count as oldest; the struct compares the time first, then the id.
_LATEST_ADDRESS = """SELECT customer_id, arg_max(struct_pack(city := city_id),
        struct_pack(at := coalesce(updated_at, TIMESTAMP '0001-01-01'), id := address_id)).city AS city_id
    FROM s_customer_address{x} GROUP BY customer_id"""

# natural key, surrogate key, output columns with types, tracked columns, business date
_DIMS = {
    "dim_customer": (
        "customer_id", "customer_key",
        "customer_no string, first_name string, last_name string, email string, phone string, "
        "date_of_birth date, gender string, registration_date date, status string, city string, country string",
        "first_name last_name email phone status city country", "registration_date",
    ),
    "dim_content": (
        "content_id", "content_key",
        "title string, release_date date, duration_minutes int, language string, age_rating string",
        "title duration_minutes language age_rating", "release_date",
    ),
    "dim_subscription_plan": (
        "plan_id", "plan_key",
        "plan_name string, monthly_fee decimal(10,2), video_quality string, max_devices int",
        "plan_name monthly_fee video_quality max_devices", None,
    ),
    "dim_inventory": (
        "inventory_id", "inventory_key",
        "content_key bigint, warehouse_key bigint, barcode string, purchase_date date, "
        "item_condition string, status string",
        "item_condition status warehouse_key", "purchase_date",
    ),
    "dim_warehouse": ("warehouse_id", "warehouse_key", "warehouse_name string, city string", "", None),
}


def _dim_source(name: str, x: str, cut: str | None, dims: str) -> list[str]:
    """CTEs up to src_<name><x>: the enriched rows. `dims` is the suffix of the dimensions looked up."""
    def s(*tables: str) -> list[str]:
        return [_s(t, x, cut) for t in tables]

    if name == "dim_customer":
        return s("customer", "customer_address", "city", "country") + [
            f"""src_{name}{x} AS (SELECT c.*, ci.city_name AS city, co.country_name AS country
                FROM s_customer{x} c LEFT JOIN ({_LATEST_ADDRESS.format(x=x)}) a USING (customer_id)
                LEFT JOIN s_city{x} ci ON a.city_id = ci.city_id
                LEFT JOIN s_country{x} co ON ci.country_id = co.country_id)"""
        ]
    if name == "dim_warehouse":
        return s("warehouse", "city") + [
            f"""src_{name}{x} AS (SELECT w.*, ci.city_name AS city
                FROM s_warehouse{x} w LEFT JOIN s_city{x} ci USING (city_id))"""
        ]
    if name == "dim_inventory":
        lookups = [] if dims != x else _dim("dim_content", x, cut) + _dim("dim_warehouse", x, cut)
        return lookups + s("inventory_item") + [
            f"""src_{name}{x} AS (SELECT i.*, content_key, warehouse_key FROM s_inventory_item{x} i
                LEFT JOIN (SELECT * FROM dim_content{dims} WHERE is_current) c USING (content_id)
                LEFT JOIN dim_warehouse{dims} w USING (warehouse_id))"""
        ]
    table = {"dim_content": "content", "dim_subscription_plan": "subscription_plan"}[name]
    return s(table) + [f"src_{name}{x} AS (SELECT * FROM s_{table}{x})"]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _dim(name: str, x: str = "", cut: str | None = None) -> list[str]:
    """CTEs up to <name><x>: the dimension of a full load."""
    natural, surrogate, schema, tracked, business = _DIMS[name]
    columns = ", ".join(_names(schema))
    if tracked:
        start = f"coalesce({business + ', ' if business else ''}CAST(created_at AS DATE), DATE '2020-01-01')"
        validity = f", {start} AS effective_from, DATE '9999-12-31' AS effective_to, true AS is_current"
    else:
        validity = ""
    return _dim_source(name, x, cut, x) + [
        f"{name}{x} AS (SELECT {_key(natural)} AS {surrogate}, {natural}, {columns}{validity} FROM src_{name}{x})"
    ]


def _dim_output(name: str, relation: str) -> str:
    natural, surrogate, schema, tracked, _ = _DIMS[name]
    full = f"{surrogate} bigint, {natural} bigint, {schema}"
    if tracked:
        full += ", effective_from date, effective_to date, is_current boolean"
    return f"SELECT {_plain(full)} FROM {relation}"


def _dim_merged(name: str) -> list[str]:
    """CTEs up to <name>: the dimension of a load before its cut (<name>_0), merged with the rest."""
    natural, surrogate, schema, tracked, _ = _DIMS[name]
    names, x = _names(schema), f"_{name}0"
    ctes = _dim(name, x, cut_of(name)) + _dim_source(name, "", None, x)
    ctes.append(
        f"""batch_{name} AS (SELECT *, CAST(coalesce(updated_at, created_at) AS DATE) AS changed_on
            FROM src_{name} WHERE {_changed(just_before(cut_of(name)))})"""
    )
    top = f"(SELECT coalesce(max({surrogate}), 0) FROM {name}{x})"
    if not tracked:
        ctes.append(
            f"""{name} AS (
                SELECT * FROM {name}{x} WHERE {natural} NOT IN (SELECT {natural} FROM batch_{name})
                UNION ALL SELECT d.{surrogate}, b.{natural}, {', '.join('b.' + c for c in names)}
                FROM batch_{name} b JOIN {name}{x} d USING ({natural})
                UNION ALL SELECT {top} + {_key(natural)}, {natural}, {', '.join(names)} FROM batch_{name}
                WHERE {natural} NOT IN (SELECT {natural} FROM {name}{x}))"""
        )
        return ctes
    columns = tracked.split()
    differs = " OR ".join(f"d.{c} IS DISTINCT FROM b.{c}" for c in columns)
    equal = " AND ".join(f"d.{c} IS NOT DISTINCT FROM b.{c}" for c in columns)
    ctes.append(
        f"""closing_{name} AS (SELECT d.{surrogate}, b.changed_on FROM {name}{x} d JOIN batch_{name} b
            ON d.{natural} = b.{natural} WHERE d.is_current AND ({differs}))"""
    )
    ctes.append(
        f"""{name} AS (
            SELECT {surrogate}, {natural}, {', '.join(names)}, effective_from,
                CASE WHEN changed_on IS NULL THEN effective_to ELSE changed_on - 1 END AS effective_to,
                is_current AND changed_on IS NULL AS is_current
            FROM {name}{x} LEFT JOIN closing_{name} USING ({surrogate})
            UNION ALL
            SELECT {top} + {_key(natural)}, {natural}, {', '.join(names)}, changed_on, DATE '9999-12-31', true
            FROM batch_{name} b WHERE NOT EXISTS (SELECT 1 FROM {name}{x} d
                WHERE d.{natural} = b.{natural} AND d.is_current AND {equal}))"""
    )
    return ctes


def _dimension_checks() -> dict[str, str]:
    customer = _DIMS["dim_customer"]
    found = {
        "latest_customer_address": _with([_s("customer_address")], _LATEST_ADDRESS.format(x="")),
        "dim_customer_batch": _with(
            _dim_source("dim_customer", "", None, ""),
            f"""SELECT {_plain('customer_id bigint, ' + customer[2] + ', updated_at timestamp')}
                FROM src_dim_customer WHERE {_changed(CUT_WATERMARK)}""",
        ),
    }
    for name in _DIMS:
        found[f"{name}_full"] = _with(_dim(name), _dim_output(name, name))
        found[f"{name}_incremental"] = _with(_dim_merged(name), _dim_output(name, name))
    return found


# --- lookups ----------------------------------------------------------------------------


def _at_day(days: str, dim: str, natural: str, answer: str, when: str, partition: str) -> str:
    """SELECT with the version of `dim` that answers for each row of `days`: one that is
    valid, else the current one, else the one of the highest key, as the greatest struct."""
    names = answer.split()
    held = ", ".join(f"{c} := v.{c}" for c in names)
    rank = f"""struct_pack(valid := coalesce({when} BETWEEN v.effective_from AND v.effective_to, false),
            now := v.is_current, k := v.{names[0]})"""
    return f"""SELECT {partition}, {', '.join(f'best.{c} AS {c}' for c in names)} FROM (
        SELECT x.*, (SELECT arg_max(struct_pack({held}), {rank}) FROM {dim} v WHERE v.{natural} = x.{natural}) AS best
        FROM {days} x) x WHERE best IS NOT NULL"""


_SESSION_DAYS = "days AS (SELECT DISTINCT user_id AS customer_id, CAST(ts AS DATE) AS activity_date FROM events)"


def _lookup_checks() -> dict[str, str]:
    versions = """versions AS (SELECT o_custkey AS customer_id, o_orderkey AS customer_key,
        CAST(o_orderdate + INTERVAL '25' YEAR AS DATE) AS effective_from,
        CASE WHEN o_orderkey % 6 = 0 THEN DATE '9999-12-31'
             ELSE CAST(o_orderdate + INTERVAL '25' YEAR AS DATE) + CAST(o_orderkey % 1500 - 20 AS INT) END AS effective_to,
        o_orderkey % 6 = 0 AS is_current FROM orders)"""
    few = "few AS (SELECT DISTINCT customer_id % 5 AS customer_id, activity_date FROM days)"
    many = "many AS (SELECT * REPLACE (customer_id % 5 AS customer_id) FROM versions)"
    pick_many = _at_day("few", "many", "customer_id", "customer_key", "x.activity_date", "x.customer_id, x.activity_date")
    active = """SELECT customer_id, CAST(activity_date AS VARCHAR) AS activity_date, subscription_id, plan_id FROM (
                SELECT d.*, s.subscription_id, s.plan_id, row_number() OVER (
                    PARTITION BY d.customer_id, d.activity_date
                    ORDER BY s.start_date DESC NULLS LAST, s.subscription_id DESC NULLS LAST) AS rn
                FROM {days} d LEFT JOIN {subs} s ON d.customer_id = s.customer_id AND d.activity_date >= s.start_date
                    AND (s.end_date IS NULL OR d.activity_date <= s.end_date)) WHERE rn = 1"""
    subs = f"subs AS ({source_sql('customer_subscription')})"
    pick = _at_day("days", "versions", "customer_id", "customer_key", "x.activity_date", "x.customer_id, x.activity_date")
    return {
        "pit_lookup_fallback": _with(
            [_SESSION_DAYS, versions],
            f"SELECT customer_id, CAST(activity_date AS VARCHAR) AS activity_date, customer_key FROM ({pick})",
        ),
        "active_interval_lookup": _with([_SESSION_DAYS, subs], active.format(days="days", subs="subs")),
        "pit_lookup_many_versions": _with(
            [_SESSION_DAYS, versions, few, many],
            f"SELECT customer_id, CAST(activity_date AS VARCHAR) AS activity_date, customer_key FROM ({pick_many})",
        ),
        "active_interval_many": _with(
            [_SESSION_DAYS, subs, few, "held AS (SELECT * REPLACE (customer_id % 5 AS customer_id) FROM subs)"],
            active.format(days="few", subs="held"),
        ),
    }


# --- facts ------------------------------------------------------------------------------


def _customer_fact(x: str, settled_only: bool = True) -> list[str]:
    """CTEs up to fact<x>, with the natural key and the day, over silver tables s_...<x>."""
    status = "WHERE status IS NULL OR status = 'COMPLETED'" if settled_only else ""

    def agg(name: str, table: str, at: str, measures: str, where: str = "") -> str:
        return f"""{name}{x} AS (SELECT customer_id, CAST({at} AS DATE) AS activity_date, {measures}
            FROM (SELECT * FROM s_{table}{x} {where})
            WHERE customer_id IS NOT NULL AND {at} IS NOT NULL GROUP BY 1, 2)"""

    parts = [
        agg("streams", "streaming_session", "start_time", "count(*) AS n, coalesce(sum(watch_duration), 0) AS d"),
        agg("starts", "rental", "rental_date", "count(*) AS n"),
        agg("returns", "rental", "return_date", "count(*) AS n"),
        agg("paid", "payment", "payment_date", "coalesce(sum(amount), 0) AS amount", status),
        agg("all_paid", "payment", "payment_date", "count(*) AS n"),
        agg("tickets", "support_ticket", "opened_date", "count(*) AS n"),
    ]
    days = " UNION ".join(
        f"SELECT customer_id, activity_date FROM {t}{x}" for t in ("streams", "starts", "returns", "all_paid", "tickets")
    )
    key = "x.customer_id, x.activity_date"
    return parts + [
        f"days{x} AS ({days})",
        f"""subs{x} AS (SELECT * FROM (SELECT d.customer_id, d.activity_date, s.plan_id,
                row_number() OVER (PARTITION BY d.customer_id, d.activity_date
                    ORDER BY s.start_date DESC, s.subscription_id DESC) AS rn
            FROM days{x} d JOIN s_customer_subscription s ON d.customer_id = s.customer_id
                AND d.activity_date >= s.start_date AND (s.end_date IS NULL OR d.activity_date <= s.end_date))
            WHERE rn = 1)""",
        f"plans{x} AS ({_at_day(f'subs{x}', 'dim_subscription_plan', 'plan_id', 'plan_key', 'x.activity_date', key)})",
        f"who{x} AS ({_at_day(f'days{x}', 'dim_customer', 'customer_id', 'customer_key', 'x.activity_date', key)})",
        f"""fact{x} AS (SELECT customer_id, activity_date, customer_key, date_key, plan_key AS subscription_plan_key,
                coalesce(streams{x}.n, 0) AS stream_count, coalesce(streams{x}.d, 0) AS total_streaming_duration,
                coalesce(starts{x}.n, 0) AS rental_count, coalesce(returns{x}.n, 0) AS returned_item_count,
                coalesce(paid{x}.amount, 0) AS total_amount_spent, coalesce(tickets{x}.n, 0) AS support_ticket_count
            FROM who{x} JOIN cal ON activity_date = full_date
            LEFT JOIN plans{x} USING (customer_id, activity_date)
            LEFT JOIN streams{x} USING (customer_id, activity_date)
            LEFT JOIN starts{x} USING (customer_id, activity_date)
            LEFT JOIN returns{x} USING (customer_id, activity_date)
            LEFT JOIN paid{x} USING (customer_id, activity_date)
            LEFT JOIN tickets{x} USING (customer_id, activity_date))""",
    ]


def _content_fact(x: str) -> list[str]:
    def month(at: str) -> str:
        return f"CAST(strftime({at}, '%Y%m') AS INT) AS month_key"

    key = "x.content_id, x.month_key"
    first_day = "make_date(x.month_key // 100, x.month_key % 100, 1)"
    return [
        f"""streams{x} AS (SELECT content_id, {month('start_time')}, count(*) AS n FROM s_streaming_session{x}
            WHERE content_id IS NOT NULL AND start_time IS NOT NULL GROUP BY 1, 2)""",
        f"""rents{x} AS (SELECT content_id, {month('rental_date')}, count(*) AS n,
                sum(coalesce(rental_fee, 0) + coalesce(late_fee, 0)) AS fees
            FROM s_rental{x} JOIN s_inventory_item USING (inventory_id)
            WHERE content_id IS NOT NULL AND rental_date IS NOT NULL GROUP BY 1, 2)""",
        f"""reviews{x} AS (SELECT content_id, {month('review_date')},
                CAST(((200 * sum(rating) + count(*)) // (2 * count(*))) / 100 AS DECIMAL(5,2)) AS stars
            FROM s_review{x} WHERE content_id IS NOT NULL AND review_date IS NOT NULL AND rating IS NOT NULL
            GROUP BY 1, 2)""",
        f"""wishes{x} AS (SELECT content_id, {month('added_date')}, count(*) AS n FROM s_wishlist{x}
            WHERE content_id IS NOT NULL AND added_date IS NOT NULL GROUP BY 1, 2)""",
        f"""spine{x} AS (SELECT content_id, month_key FROM streams{x} UNION SELECT content_id, month_key FROM rents{x}
            UNION SELECT content_id, month_key FROM reviews{x} UNION SELECT content_id, month_key FROM wishes{x})""",
        f"what{x} AS ({_at_day(f'spine{x}', 'dim_content', 'content_id', 'content_key', first_day, key)})",
        f"""fact{x} AS (SELECT content_id, month_key, content_key, coalesce(streams{x}.n, 0) AS total_stream_count,
                coalesce(rents{x}.n, 0) AS total_rental_count, coalesce(fees, 0) AS revenue_generated,
                stars AS average_customer_rating, coalesce(wishes{x}.n, 0) AS wishlist_addition_count
            FROM what{x} JOIN months USING (month_key)
            LEFT JOIN streams{x} USING (content_id, month_key) LEFT JOIN rents{x} USING (content_id, month_key)
            LEFT JOIN reviews{x} USING (content_id, month_key) LEFT JOIN wishes{x} USING (content_id, month_key))""",
    ]


def _inventory_fact(x: str) -> list[str]:
    def agg(name: str, at: str) -> str:
        return f"""{name}{x} AS (SELECT inventory_id, CAST({at} AS DATE) AS activity_date, count(*) AS n
            FROM s_rental{x} WHERE inventory_id IS NOT NULL AND {at} IS NOT NULL GROUP BY 1, 2)"""

    key = "x.inventory_id, x.activity_date"
    items = _at_day(
        f"days{x}", "dim_inventory", "inventory_id", "inventory_key warehouse_key", "x.activity_date", key
    )
    return [
        agg("starts", "rental_date"),
        agg("returns", "return_date"),
        f"""days{x} AS (SELECT inventory_id, activity_date FROM starts{x}
            UNION SELECT inventory_id, activity_date FROM returns{x})""",
        f"item{x} AS ({items})",
        f"""fact{x} AS (SELECT inventory_id, activity_date, inventory_key, warehouse_key, date_key,
                coalesce(starts{x}.n, 0) AS rental_count, coalesce(returns{x}.n, 0) AS return_count,
                CASE WHEN coalesce(starts{x}.n, 0) > 0 THEN 0 ELSE 1 END AS days_available,
                CASE WHEN coalesce(starts{x}.n, 0) > 0 THEN 100.00 ELSE 0.00 END AS inventory_utilisation_percentage
            FROM item{x} JOIN cal ON activity_date = full_date
            JOIN dim_warehouse USING (warehouse_key)
            LEFT JOIN starts{x} USING (inventory_id, activity_date)
            LEFT JOIN returns{x} USING (inventory_id, activity_date))""",
    ]


# Output columns, natural grain, dimensions, and the sources (table, key, times) that mark keys as affected.
_FACTS = {
    "fact_customer_daily_activity": (
        "customer_key bigint, date_key int, subscription_plan_key bigint, stream_count bigint, "
        "total_streaming_duration int, rental_count bigint, returned_item_count bigint, "
        "total_amount_spent decimal(14,2), support_ticket_count bigint",
        "customer_id, activity_date",
        ("dim_customer", "dim_subscription_plan"),
    ),
    "fact_content_monthly_performance": (
        "content_key bigint, month_key int, total_stream_count bigint, total_rental_count bigint, "
        "revenue_generated decimal(14,2), average_customer_rating decimal(5,2), wishlist_addition_count bigint",
        "content_id, month_key",
        ("dim_content",),
    ),
    "fact_inventory_daily_utilisation": (
        "inventory_key bigint, warehouse_key bigint, date_key int, rental_count bigint, return_count bigint, "
        "days_available int, inventory_utilisation_percentage decimal(5,2)",
        "inventory_id, activity_date",
        ("dim_inventory",),
    ),
}
_PLACING = {"customer_subscription", "inventory_item"}


def _fact_ctes(name: str, x: str, cut: str | None, settled_only: bool = True) -> list[str]:
    tables = [t for t in FACT_TABLES[name] if t not in _PLACING]
    ctes = [_s(t, x, cut) for t in tables] + [_s(t) for t in FACT_TABLES[name] if t in _PLACING]
    if name == "fact_customer_daily_activity":
        return ctes + _customer_fact(x, settled_only)
    return ctes + (_content_fact(x) if name == "fact_content_monthly_performance" else _inventory_fact(x))


def _fact_dims(name: str, merged: bool = True) -> list[str]:
    """CTEs of the dimensions a fact looks up: with several versions, or of one full load."""
    made = [cte for d in _FACTS[name][2] for cte in (_dim_merged(d) if merged else _dim(d))]
    if merged and "dim_inventory" in _FACTS[name][2]:
        made.append("dim_warehouse AS (SELECT * FROM dim_warehouse_dim_inventory0)")
    return [_DAYS, _MONTHS, *made]


def fact_table(name: str, settled_only: bool = True, merged: bool = True) -> str:
    return _with(
        _fact_dims(name, merged) + _fact_ctes(name, "", None, settled_only),
        f"SELECT {_plain(_FACTS[name][0])} FROM fact",
    )


def fact_by_natural_key(name: str) -> str:
    """The fact of one full load, with natural keys in place of the surrogate keys."""
    natural, surrogate = _FACTS[name][1].split(", ")[0], _FACTS[name][0].split()[0]
    columns = [c for c in _FACTS[name][0].split(", ") if c.split()[0] not in (surrogate, "subscription_plan_key", "warehouse_key")]
    kinds, joins = [*columns, f"{natural} bigint"], ""
    if name == "fact_customer_daily_activity":
        kinds.append("plan_id bigint")
        joins = "LEFT JOIN dim_subscription_plan p ON p.plan_key = subscription_plan_key"
    if name == "fact_inventory_daily_utilisation":
        kinds.append("warehouse_id bigint")
        joins = "JOIN dim_warehouse w ON w.warehouse_key = fact.warehouse_key"
    return _with(_fact_dims(name, False) + _fact_ctes(name, "", None), f"SELECT {_plain(', '.join(kinds))} FROM fact {joins}")


def _affected(name: str) -> str:
    changed = _changed(EVENT_WATERMARK)

    def keys(table: str, at: str, natural: str) -> str:
        if name == "fact_content_monthly_performance":
            bucket = f"CAST(strftime({at}, '%Y%m') AS INT) AS month_key"
        else:
            bucket = f"CAST({at} AS DATE) AS activity_date"
        return f"SELECT {natural}, {bucket} FROM (SELECT * FROM s_{table} WHERE {changed}) WHERE {at} IS NOT NULL"

    if name == "fact_customer_daily_activity":
        parts = [
            keys("streaming_session", "start_time", "customer_id"),
            keys("rental", "rental_date", "customer_id"),
            keys("rental", "return_date", "customer_id"),
            keys("payment", "payment_date", "customer_id"),
            keys("support_ticket", "opened_date", "customer_id"),
        ]
    elif name == "fact_content_monthly_performance":
        rented = f"""SELECT content_id, CAST(strftime(rental_date, '%Y%m') AS INT) AS month_key
            FROM (SELECT * FROM s_rental WHERE {changed}) JOIN s_inventory_item USING (inventory_id)"""
        parts = [
            keys("streaming_session", "start_time", "content_id"),
            rented,
            keys("review", "review_date", "content_id") + " AND rating IS NOT NULL",
            keys("wishlist", "added_date", "content_id"),
        ]
    else:
        parts = [
            keys("rental", "rental_date", "inventory_id"),
            keys("rental", "return_date", "inventory_id"),
        ]
    natural = _FACTS[name][1].split(", ")[0]
    return f"affected AS (SELECT * FROM ({' UNION '.join(parts)}) WHERE {natural} IS NOT NULL)"


def fact_in_two_loads(name: str) -> str:
    schema, grain, _ = _FACTS[name]
    hit = " AND ".join(f"a.{c} = f.{c}" for c in grain.split(", "))
    return _with(
        _fact_dims(name) + _fact_ctes(name, "0", EVENT_CUT) + _fact_ctes(name, "", None) + [_affected(name)],
        f"""SELECT {_plain(schema)} FROM (
            SELECT * FROM fact0 f WHERE NOT EXISTS (SELECT 1 FROM affected a WHERE {hit})
            UNION ALL SELECT * FROM fact f WHERE EXISTS (SELECT 1 FROM affected a WHERE {hit}))""",
    )


def _load_checks() -> dict[str, str]:
    kinds = "payment_id bigint, customer_id bigint, amount decimal(10,2), payment_date timestamp, payment_type string, load bigint"

    def landed(load: int, kind: str, where: str) -> str:
        return f"SELECT * REPLACE ({kind} AS payment_type), CAST({load} AS BIGINT) AS load FROM p WHERE {where}"

    changed = "CASE WHEN payment_id % 7 = 0 THEN 'moved' ELSE payment_type END"
    loads = [
        landed(0, "payment_type", "payment_id % 10 <> 0"),
        landed(1, changed, "payment_id % 10 = 0 OR payment_id % 7 = 0"),
        landed(2, "payment_type", "payment_id % 14 = 0"),
    ]
    found = {"bronze_undated_loads": _with([f"p AS ({source_sql('payment')})"], f"SELECT {_plain(kinds)} FROM ({' UNION ALL '.join(loads)})")}
    for name, column in (("customer", "customer_id"), ("item", "inventory_id")):
        found[f"rental_months_by_{name}"] = _with(
            [_s("rental")],
            f"""SELECT DISTINCT {column}, CAST(strftime(rental_date, '%Y%m') AS INTEGER) AS month_key
                FROM s_rental WHERE {column} IS NOT NULL AND rental_date IS NOT NULL""",
        )
    return found


def _fact_checks() -> dict[str, str]:
    name = "fact_customer_daily_activity"
    found = {f"{name}_all_payments": fact_table(name, settled_only=False)}
    for fact in _FACTS:
        natural, bucket = _FACTS[fact][1].split(", ")
        if bucket == "month_key":
            body = f"SELECT {natural}, month_key FROM affected JOIN months USING (month_key)"
        else:
            body = f"""SELECT {natural}, CAST(activity_date AS VARCHAR) AS activity_date
                FROM affected JOIN cal ON activity_date = full_date"""
        found[f"{fact}_affected"] = _with([_DAYS, _MONTHS, *[_s(t) for t in FACT_TABLES[fact]], _affected(fact)], body)
        found[f"{fact}_late"] = found[f"{fact}_few_months"] = fact_by_natural_key(fact)
        found[fact] = fact_table(fact)
        found[f"{fact}_incremental"] = fact_in_two_loads(fact)
    return found


def oracle_sql() -> dict[str, str]:
    found = {**_bronze_checks(), **_operator_checks()}
    for table in TABLES:
        found[f"silver_{table}"] = silver_table(table)
    for table, cut in TWO_LOADS.items():
        found[f"silver_{table}_incremental"] = silver_in_two_loads(table, cut)
    # the stored loads all end where one full load ends
    facts = [f"SELECT '{f}' AS fact, * FROM ({fact_by_natural_key(f)})" for f in _FACTS]
    for load in ("full_load", "incremental_load", "backfill"):
        found[f"pipeline_{load}"] = " UNION ALL BY NAME ".join(facts)
    return {**found, **_calendar_checks(), **_dimension_checks(), **_lookup_checks(), **_load_checks(), **_fact_checks()}
