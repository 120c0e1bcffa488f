"""The layers again as plain SQL, for checking results on another engine.

Every function returns the text of one query; :func:`with_tables` puts the ones a query needs
in front of it as common table expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from strata.specs.gold import GOLD_DDL
from strata.specs.lines import LINES, Line, TableSpec, silver_specs
from strata.specs.reference import COMMISSION_TIERS, COVERAGES, LINES_OF_BUSINESS, RISK_TIERS, US_STATES
from strata.workload.raw import BRONZE_TABLES, CLAIM_TABLES, POLICY_TABLES, bronze_sql

AS_OF = "2000-06-30"


def fields(ddl: str) -> dict[str, str]:
    """{column: SQL type} of a DDL string."""
    text = " ".join(ddl.replace(" not null", "").split())
    result, depth, start = {}, 0, 0
    for i, ch in enumerate(text + ","):
        depth += (ch in "(<") - (ch in ")>")
        if ch == "," and depth == 0:
            name, kind = text[start:i].strip().split(" ", 1)
            result[name] = kind
            start = i + 1
    return result


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '__NULL__')" for c in columns)
    return f"md5(concat_ws('||', {parts}))"


def opt_key(column: str) -> str:
    return f"case when {column} is not null then {key(column)} end"


def date_key(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as int)"


def bucket(column: str, n: int) -> str:
    return f"(('0x' || substr(md5(cast({column} as varchar)), 1, 8))::bigint % {n})"


def label(column: str, labels: Sequence[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(labels))
    return f"case {bucket(column, len(labels))} {whens} end"


def ratio(numerator: str, denominator: str, digits: int = 4) -> str:
    """Exact half-up ratio of two non-negative-denominator amounts in cents."""
    a = f"cast(({numerator}) * 100 as hugeint)"
    b = f"cast(({denominator}) * 100 as hugeint)"
    scaled = f"(2 * abs({a}) * {10 ** digits} + {b}) // (2 * {b})"
    return f"cast(sign({numerator}) * {scaled} as decimal(34,{digits})) / {10 ** digits}"


def first_per(keys: str, order: str, rest: Sequence[str]) -> str:
    tail = "".join(f", {c} ASC NULLS FIRST" for c in rest)
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}{tail}) = 1"


def typed_sql(spec: TableSpec) -> str:
    """Union of the sources with Silver types, before deduplication."""
    parts = []
    columns = fields(spec.ddl)
    available = (POLICY_TABLES if spec.sources[0] in POLICY_TABLES else CLAIM_TABLES)[
        spec.sources[0]
    ][1]
    for source in spec.sources:
        texts = [
            f"cast({c} as varchar) AS {c}"
            for c in available
            if c != "_ingestion_timestamp"
        ]
        parts.append(
            f"SELECT {', '.join(texts)}, _ingestion_timestamp FROM ({bronze_sql(source)})"
        )
    casts = []
    for name, kind in columns.items():
        if name not in available:
            casts.append(f"cast(null as {kind}) AS {name}")
        elif kind == "string":
            text = f"trim({name})"
            casts.append(f"{f'upper({text})' if name in spec.upper else text} AS {name}")
        else:
            casts.append(f"try_cast(trim({name}) AS {kind}) AS {name}")
    replaced = ", ".join(f"{sql} AS {c}" for c, sql in spec.derived.items())
    star = f"* REPLACE ({replaced})" if replaced else "*"
    return (
        f"SELECT {star} FROM (SELECT {', '.join(casts)}, _ingestion_timestamp "
        f"FROM ({' UNION ALL '.join(parts)}))"
    )


def check_sql(spec: TableSpec) -> str:
    cases = []
    for kind, column, name, *argument in spec.checks:
        if kind == "not_null":
            fails, default = f"{column} IS NULL", f"null_{column}"
        elif kind == "positive":
            fails, default = f"{column} < 0", f"non_positive_{column}"
        elif kind == "in_set":
            values = ", ".join(f"'{v}'" for v in argument[0])
            fails, default = f"{column} NOT IN ({values})", f"invalid_{column}"
        else:
            fails, default = f"{column} > {argument[0]}", f"{column}_exceeds_{argument[0]}"
        cases.append(f"CASE WHEN {fails} THEN '{name or default}' END")
    return f"concat_ws('; ', {', '.join(cases)})"


def silver_sql(spec: TableSpec) -> str:
    columns = list(fields(spec.ddl))
    rest = [c for c in columns if c != spec.key]
    issues = check_sql(spec)
    return (
        f"SELECT {', '.join(columns)}, {issues} = '' AS _is_valid, {issues} AS _dq_issues, "
        # The extra level makes the order see derived columns, not the ones they replace.
        f"_ingestion_timestamp FROM (SELECT * FROM ({typed_sql(spec)}) "
        f"{first_per(spec.key, '_ingestion_timestamp DESC NULLS LAST', rest)})"
    )


def _rows(rows: Sequence[tuple], names: str) -> str:
    def text(v) -> str:
        return str(v).lower() if isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'"

    values = ", ".join(f"({', '.join(text(v) for v in row)})" for row in rows)
    return f"(VALUES {values}) AS t({names})"


def _ordered(table: str, source: str) -> str:
    """The declared columns with their declared types."""
    casts = [f"cast({c} as {k}) AS {c}" for c, k in fields(GOLD_DDL[table]).items()]
    return f"SELECT {', '.join(casts)} FROM ({source})"


def _union(parts: Sequence[str]) -> str:
    return " UNION ALL ".join(parts)


def location_id(line: Line) -> str:
    if line.location is None:
        return "cast(null as varchar)"
    parts = [
        f"coalesce(cast({line.location.get(c, 'null')} as varchar), '')"
        for c in ("address_line1", "city", "state_code", "zip_code")
    ]
    return f"md5(concat_ws('||', {', '.join(parts)}))"


def _mapped(mapping: dict[str, str], names: dict[str, str]) -> str:
    return ", ".join(f"cast({mapping.get(c, 'null')} as {k}) AS {c}" for c, k in names.items())


def dim_date_sql() -> str:
    d = "full_date"
    return (
        f"SELECT {date_key(d)} AS date_key, full_date, cast(year({d}) as int) AS year, "
        f"cast(quarter({d}) as int) AS quarter, cast(month({d}) as int) AS month, "
        f"strftime({d}, '%B') AS month_name, cast(day({d}) as int) AS day, "
        f"cast(dayofweek({d}) + 1 as int) AS day_of_week, strftime({d}, '%A') AS day_name, "
        f"dayofweek({d}) IN (0, 6) AS is_weekend, false AS is_holiday, "
        f"cast(CASE WHEN month({d}) >= 10 THEN year({d}) + 1 ELSE year({d}) END as int) "
        f"AS fiscal_year, cast(CASE WHEN month({d}) >= 10 THEN 1 WHEN month({d}) <= 3 THEN 2 "
        f"WHEN month({d}) <= 6 THEN 3 ELSE 4 END as int) AS fiscal_quarter FROM "
        "(SELECT cast(unnest(generate_series(DATE '1970-01-01', DATE '2035-12-31', "
        "INTERVAL 1 DAY)) as date) AS full_date)"
    )


def dim_lob_sql() -> str:
    names = "lob_code, lob_name, lob_category, regulatory_body, naic_code"
    return f"SELECT {key('lob_code')} AS lob_key, {names} FROM {_rows(LINES_OF_BUSINESS, names)}"


def dim_coverage_sql() -> str:
    names = (
        "lob_code, coverage_id, coverage_code, coverage_name, coverage_type, "
        "coverage_description, is_mandatory"
    )
    return _ordered(
        "dim_coverage",
        f"SELECT t.*, {key('coverage_id')} AS coverage_key, {key('lob_code')} AS lob_key "
        f"FROM {_rows(COVERAGES, names)}",
    )


def dim_insured_sql() -> str:
    names = {
        c: k for c, k in fields(GOLD_DDL["dim_insured"]).items()
        if c not in ("insured_key", "insured_id")
    }
    parts = [
        f"SELECT policy_id AS insured_id, {_mapped(line.insured, names)} FROM {line.policies.name}"
        for line in LINES
    ]
    rest = [c for c in names if c != "insured_name"]
    return _ordered(
        "dim_insured",
        f"SELECT *, {key('insured_id')} AS insured_key FROM ({_union(parts)}) "
        + first_per("insured_id", "insured_name ASC NULLS FIRST", rest),
    )


def dim_location_sql() -> str:
    made = ("location_key", "location_id", "state_name", "country", "territory_code")
    names = {c: k for c, k in fields(GOLD_DDL["dim_location"]).items() if c not in made}
    parts = [
        f"SELECT {location_id(line)} AS location_id, {_mapped(line.location, names)} "
        f"FROM {line.policies.name}"
        for line in LINES
        if line.location
    ]
    rest = [c for c in names if c != "city"]
    best = f"SELECT * FROM ({_union(parts)}) " + first_per(
        "location_id", "city ASC NULLS FIRST", rest
    )
    return _ordered(
        "dim_location",
        f"SELECT b.*, {key('location_id')} AS location_key, 'US' AS country, "
        f"b.state_code AS territory_code, s.name AS state_name FROM ({best}) b "
        f"LEFT JOIN (SELECT * FROM {_rows(US_STATES, 'code, name')}) s ON b.state_code = s.code",
    )


def dim_agent_sql() -> str:
    parts = [
        f"SELECT agent_id, agent_name, {line.agent_state} AS state_code "
        f"FROM {line.policies.name} WHERE agent_id IS NOT NULL"
        for line in LINES
    ]
    return _ordered(
        "dim_agent",
        f"SELECT *, {key('agent_id')} AS agent_key, "
        "concat('Agency_', substr(agent_id, 5, 6)) AS agency_name, "
        "substr(agent_id, 5, 6) AS agency_code, concat('LIC-', agent_id) AS license_number, "
        f"{label('agent_id', COMMISSION_TIERS)} AS commission_tier FROM ({_union(parts)}) "
        + first_per("agent_id", "agent_name ASC NULLS FIRST", ["state_code"]),
    )


def dim_policy_sql() -> str:
    parts = [
        f"SELECT policy_id, policy_number, '{line.code}' AS lob_code, agent_id, "
        f"{location_id(line)} AS location_id, effective_date, expiration_date, underwriter "
        f"FROM {line.policies.name}"
        for line in LINES
    ]
    rest = (
        "policy_number", "lob_code", "agent_id", "location_id", "expiration_date", "underwriter",
    )
    return _ordered(
        "dim_policy",
        f"SELECT *, {key('policy_id')} AS policy_key, {key('lob_code')} AS lob_key, "
        f"{key('policy_id')} AS insured_key, {opt_key('agent_id')} AS agent_key, "
        f"{opt_key('location_id')} AS location_key, "
        f"{date_key('effective_date')} AS effective_date_key, "
        f"{date_key('expiration_date')} AS expiration_date_key, 'Active' AS policy_status, "
        "cast(datesub('month', effective_date, expiration_date) as int) AS policy_term_months, "
        f"{label('policy_id', RISK_TIERS)} AS risk_tier, false AS is_renewal, "
        f"cast(null as varchar) AS original_policy_id FROM ({_union(parts)}) "
        + first_per("policy_id", "effective_date DESC NULLS LAST", rest),
    )


def dim_claim_sql() -> str:
    names = {
        "claimant_name": "varchar", "claimant_type": "varchar", "cause_of_loss": "varchar",
        "claim_type": "varchar", "claim_status": "varchar", "litigation_flag": "boolean",
    }
    parts = []
    for line in LINES:
        mapping = {"litigation_flag": "false", "claim_status": "claim_status", **line.claim}
        parts.append(
            f"SELECT claim_id, policy_id, {mapping['date_of_loss']} AS date_of_loss, "
            f"{_mapped(mapping, names)} FROM {line.claims.name}"
        )
    best = f"SELECT * FROM ({_union(parts)}) " + first_per(
        "claim_id", "date_of_loss DESC NULLS LAST", ["policy_id", *names]
    )
    return _ordered(
        "dim_claim",
        f"SELECT c.*, {key('c.claim_id')} AS claim_key, c.claim_id AS claim_number, "
        f"p.policy_key, {date_key('date_of_loss')} AS date_of_loss_key, "
        f"{date_key('date_of_loss')} AS date_reported_key, "
        "cast(null as varchar) AS catastrophe_code, cast(null as varchar) AS adjuster_name "
        f"FROM ({best}) c LEFT JOIN dim_policy p ON c.policy_id = p.policy_id",
    )


def fact_premium_sql() -> str:
    parts = [
        f"SELECT policy_id, effective_date, '{line.code}' AS lob_code, "
        f"{location_id(line)} AS location_id, premium_amount AS written_premium, "
        f"cast({line.coverage_limit} as decimal(18,2)) AS coverage_limit, "
        f"cast({line.deductible} as decimal(18,2)) AS deductible_amount, "
        f"'{line.coverage_id}' AS coverage_id FROM {line.policies.name}"
        for line in LINES
    ]

    def cut(rate: str) -> str:
        return f"cast(written_premium * {rate} as decimal(18,2))"

    return _ordered(
        "fact_premium",
        f"SELECT f.*, {key('f.policy_id', 'coverage_id', date_key('effective_date'))} "
        f"AS premium_key, p.policy_key, p.lob_key, p.location_key, "
        f"{key('coverage_id')} AS coverage_key, {date_key('effective_date')} AS date_key, "
        f"written_premium AS earned_premium, {cut('0.15')} AS ceded_premium, "
        f"written_premium - {cut('0.15')} AS net_premium, {cut('0.12')} AS commission_amount, "
        f"{cut('0.03')} AS tax_amount FROM ({_union(parts)}) f "
        "LEFT JOIN dim_policy p ON f.policy_id = p.policy_id",
    )


def fact_claim_sql() -> str:
    def cents(sql: str) -> str:
        return f"cast(coalesce({sql}, 0) as decimal(18,2))"

    parts = [
        f"SELECT claim_id, policy_id, {line.claim['date_of_loss']} AS transaction_date, "
        f"'payment' AS transaction_type, {cents(line.paid)} AS paid_amount, "
        f"{cents(line.reserve)} AS reserve_amount, "
        f"coalesce(claim_status = 'Closed', false) AS is_final_payment FROM {line.claims.name}"
        for line in LINES
    ]
    return _ordered(
        "fact_claim_transaction",
        f"SELECT f.*, {key('claim_id', 'transaction_date', 'transaction_type')} AS claim_txn_key, "
        f"{opt_key('claim_id')} AS claim_key, p.policy_key, p.lob_key, "
        f"{date_key('transaction_date')} AS date_key, 0 AS recovery_amount, 0 AS expense_amount, "
        f"paid_amount + reserve_amount AS total_incurred FROM ({_union(parts)}) f "
        "LEFT JOIN dim_policy p ON f.policy_id = p.policy_id",
    )


def fact_policy_sql() -> str:
    parts = [
        f"SELECT policy_id, effective_date, premium_amount AS premium_change, "
        f"'new_business' AS transaction_type FROM {line.policies.name}"
        for line in LINES
    ]
    return _ordered(
        "fact_policy_transaction",
        f"SELECT f.*, {key('f.policy_id', 'transaction_type', 'effective_date')} "
        f"AS policy_txn_key, p.policy_key, p.lob_key, {date_key('effective_date')} AS date_key, "
        f"effective_date AS processed_date FROM ({_union(parts)}) f "
        "LEFT JOIN dim_policy p ON f.policy_id = p.policy_id",
    )


PREMIUM_ROLLUP = (
    "SELECT policy_key, cast(sum(written_premium) as decimal(28,2)) AS total_written_premium, "
    "cast(sum(earned_premium) as decimal(28,2)) AS total_earned_premium, "
    "cast(sum(net_premium) as decimal(28,2)) AS total_net_premium, "
    "cast(sum(coverage_limit) as decimal(28,2)) AS total_coverage_limit, "
    "cast(sum(deductible_amount) as decimal(28,2)) AS total_deductible, "
    "cast(sum(commission_amount) as decimal(28,2)) AS total_commission, "
    "count(*) AS premium_line_count FROM fact_premium GROUP BY policy_key"
)
CLAIMS_ROLLUP = (
    "SELECT policy_key, count(DISTINCT claim_key) AS total_claims_count, "
    "cast(sum(paid_amount) as decimal(28,2)) AS total_paid_amount, "
    "cast(sum(reserve_amount) as decimal(28,2)) AS total_reserved_amount, "
    "cast(sum(total_incurred) as decimal(28,2)) AS total_incurred, "
    "max(date_key) AS last_claim_date_key, max(paid_amount) AS largest_claim_amount "
    "FROM fact_claim_transaction GROUP BY policy_key"
)
STATUS_COUNTS = (
    "SELECT policy_key, "
    "cast(sum(CASE WHEN claim_status = 'Open' THEN 1 ELSE 0 END) as bigint) AS open_claims_count, "
    "cast(sum(CASE WHEN claim_status = 'Closed' THEN 1 ELSE 0 END) as bigint) "
    "AS closed_claims_count FROM dim_claim GROUP BY policy_key"
)


def mart_sql() -> str:
    days = (
        "datediff('day', DATE '" + AS_OF + "', "
        "cast(strptime(cast(p.expiration_date_key as varchar), '%Y%m%d') as date))"
    )
    attributes, joins = [], []
    for line in LINES:
        alias = f"x_{line.code.lower()}"
        attributes += [f"{alias}.{c} AS {name}" for name, c in line.attributes.items()]
        joins.append(f"LEFT JOIN {line.policies.name} {alias} ON p.policy_id = {alias}.policy_id")
    loss = ratio("c.total_incurred", "f.total_written_premium")
    return _ordered(
        "mart_policy_360",
        "SELECT p.*, l.lob_code, l.lob_name, l.lob_category, l.naic_code, i.insured_name, "
        "i.insured_type, i.date_of_birth AS insured_dob, i.gender AS insured_gender, "
        "i.ein AS insured_ein, i.naics_code AS insured_naics, i.industry AS insured_industry, "
        "i.employee_count AS insured_employee_count, "
        "i.annual_revenue AS insured_annual_revenue, a.agent_name, a.agency_name, "
        "a.agency_code, a.commission_tier, o.address_line1 AS policy_address, "
        "o.city AS policy_city, o.state_code AS policy_state, "
        "o.state_name AS policy_state_name, o.zip_code AS policy_zip, "
        "o.latitude AS policy_latitude, o.longitude AS policy_longitude, "
        "o.flood_zone AS policy_flood_zone, f.* EXCLUDE (policy_key), "
        "c.* EXCLUDE (policy_key), s.* EXCLUDE (policy_key), "
        f"CASE WHEN f.total_written_premium > 0 THEN {loss} END AS loss_ratio, "
        f"{', '.join(attributes)}, w.wc_injury_count, "
        f"p.policy_term_months AS policy_tenure_months, {days} AS days_until_expiry, "
        f"{days} > 0 AS is_active FROM dim_policy p "
        "LEFT JOIN dim_line_of_business l ON p.lob_key = l.lob_key "
        "LEFT JOIN dim_insured i ON p.insured_key = i.insured_key "
        "LEFT JOIN dim_agent a ON p.agent_key = a.agent_key "
        "LEFT JOIN dim_location o ON p.location_key = o.location_key "
        f"LEFT JOIN ({PREMIUM_ROLLUP}) f ON p.policy_key = f.policy_key "
        f"LEFT JOIN ({CLAIMS_ROLLUP}) c ON p.policy_key = c.policy_key "
        f"LEFT JOIN ({STATUS_COUNTS}) s ON p.policy_key = s.policy_key "
        "LEFT JOIN (SELECT policy_id, count(*) AS wc_injury_count FROM workers_comp_claims "
        "GROUP BY policy_id) w ON p.policy_id = w.policy_id " + " ".join(joins),
    )


SILVER = {spec.name: spec for spec in silver_specs()}
_POLICIES = tuple(line.policies.name for line in LINES)
_CLAIMS = tuple(line.claims.name for line in LINES)

# Table -> (query text, tables it reads).
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    **{name: (bronze_sql(name), ()) for name in BRONZE_TABLES},
    **{name: (silver_sql(spec), ()) for name, spec in SILVER.items()},
    "dim_date": (dim_date_sql(), ()),
    "dim_line_of_business": (dim_lob_sql(), ()),
    "dim_coverage": (dim_coverage_sql(), ()),
    "dim_insured": (dim_insured_sql(), _POLICIES),
    "dim_location": (dim_location_sql(), _POLICIES),
    "dim_agent": (dim_agent_sql(), _POLICIES),
    "dim_policy": (dim_policy_sql(), _POLICIES),
    "dim_claim": (dim_claim_sql(), (*_CLAIMS, "dim_policy")),
    "fact_premium": (fact_premium_sql(), (*_POLICIES, "dim_policy")),
    "fact_claim_transaction": (fact_claim_sql(), (*_CLAIMS, "dim_policy")),
    "fact_policy_transaction": (fact_policy_sql(), (*_POLICIES, "dim_policy")),
    "mart_policy_360": (
        mart_sql(),
        (
            *_POLICIES, *_CLAIMS, "dim_line_of_business", "dim_insured", "dim_agent",
            "dim_location", "dim_policy", "dim_claim", "fact_premium",
            "fact_claim_transaction",
        ),
    ),
}


def with_tables(query: str, *tables: str) -> str:
    """The query with the named tables, and what they read, defined in front of it."""
    needed: list[str] = []

    def add(name: str) -> None:
        for source in TABLES[name][1]:
            add(source)
        if name not in needed:
            needed.append(name)

    for name in tables:
        add(name)
    if not needed:
        return query
    definitions = ", ".join(f"{n} AS MATERIALIZED ({TABLES[n][0]})" for n in needed)
    return f"WITH {definitions} {query}"


def whole(table: str) -> str:
    return with_tables(f"SELECT * FROM {table}", table)
