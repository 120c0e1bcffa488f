"""Bronze tables of the five lines, derived from the order and line-item tables.

An order is a policy, its priority the line of business, and each of its line items a claim.
The derivation is plain SQL text that every engine reads alike.  It leaves in what real
feeds contain: padded and lower-case codes, malformed amounts and dates, missing values,
negative amounts, repeated claims, claims without a policy, and lines delivered twice.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from strata.session import remove_folder, scratch_path, shuffles_removed
from strata.sinks.files import write_csv, write_json_lines
from strata.sinks.tables import COMPRESSION
from strata.sources.manifest import SEMI_STRUCTURED, STRUCTURED
from strata.specs.reference import US_STATES

STATES = [code for code, _ in US_STATES if code != "DC"]
PRIORITY = {
    "PROP": "1-URGENT",
    "WC": "2-HIGH",
    "AUTO": "3-MEDIUM",
    "GL": "4-NOT SPECIFIED",
    "UMB": "5-LOW",
}


def pad(x: str, width: int) -> str:
    return f"lpad(cast({x} as string), {width}, '0')"


def pick(x: str, values: Sequence[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case cast(({x}) % {len(values)} as int) {whens} end"


def amount(x: str) -> str:
    return f"cast(cast({x} as decimal(18,2)) as string)"


def dirty(condition: str, bad: str, good: str) -> str:
    return f"case when {condition} then {bad} else {good} end"


STATE = f"substr('{''.join(STATES)}', cast(o_custkey % 50 as int) * 2 + 1, 2)"
DIRTY_STATE = (
    f"case when o_custkey % 31 = 0 then null when o_custkey % 7 = 0 "
    f"then concat(' ', lower({STATE}), ' ') else {STATE} end"
)
CITY = "concat('City_', cast(o_custkey % 1000 as string))"
ZIP = pad("(o_custkey * 7919) % 99999", 5)
STREET = "concat(cast(o_custkey % 9999 as string), ' Main St')"
PRICE = "cast(o_totalprice as decimal(18,2))"
EXTENDED = "cast(l_extendedprice as decimal(18,2))"
DISCOUNT = "cast(l_discount as decimal(4,2))"
TAX = "cast(l_tax as decimal(4,2))"
ORDER_DAY = "cast(o_orderdate as date)"
SHIP_DAY = "cast(l_shipdate as date)"


def policy_columns(prefix: str, number: str, term: int) -> dict[str, str]:
    """Columns all lines' policies share; ids come padded with blanks now and then."""
    policy = f"concat('{prefix}-', {pad('o_orderkey', 10)})"
    premium = amount(f"{PRICE} * 0.01")
    return {
        "policy_id": dirty("o_orderkey % 11 = 0", f"concat(' ', {policy}, '  ')", policy),
        "policy_number": f"concat('{number}', {pad('o_orderkey', 12)})",
        "effective_date": dirty(
            "o_custkey % 53 = 0", "'N/A'", f"cast({ORDER_DAY} as string)"
        ),
        "expiration_date": f"cast({ORDER_DAY} + {term} as string)",
        "insured_name": dirty(
            "o_custkey % 47 = 0", "null", f"concat('Customer#', {pad('o_custkey', 9)})"
        ),
        "premium_amount": f"case when o_custkey % 41 = 0 then 'N/A' "
        f"when o_custkey % 43 = 0 then concat('-', {premium}) "
        f"when o_custkey % 5 = 0 then concat(' ', {premium}, ' ') else {premium} end",
        "agent_id": dirty(
            "o_custkey % 29 = 0", "null", f"concat('AGT-', {pad('o_custkey % 5000', 6)})"
        ),
        "agent_name": "concat('Agent_', cast(o_custkey % 5000 + o_orderkey % 3 as string))",
        "underwriter": pick("o_orderkey", ["UW_Alpha", "UW_Beta", "UW_Gamma", "UW_Delta"]),
        "_ingestion_timestamp": "cast(o_orderdate as timestamp)",
    }


def claim_columns(prefix: str, policy: str, day: str) -> dict[str, str]:
    """Columns all lines' claims share; an order and line number may repeat."""
    number = pad("l_orderkey", 10)
    return {
        "claim_id": f"concat('CLM-{prefix}-', {number}, '-', cast(l_linenumber as string))",
        "policy_id": dirty(
            "l_suppkey % 23 = 0", f"concat('{policy}-X', {number})", f"concat('{policy}-', {number})"
        ),
        day: dirty("l_partkey % 61 = 0", "'unknown'", f"cast({SHIP_DAY} as string)"),
        "claim_status": "case when l_returnflag = 'R' then 'Closed' "
        "when l_returnflag = 'A' and l_linestatus = 'F' then 'Reopened' "
        "when l_returnflag = 'A' then 'Pending' when l_partkey % 67 = 0 then 'Lost' "
        "else 'Open' end",
        "_ingestion_timestamp": "cast(l_shipdate as timestamp)",
    }


POLICY_TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "property_policies_csv": (
        "PROP",
        {
            **policy_columns("PROP", "PN", 365),
            "property_state": DIRTY_STATE,
            "reported_city": CITY,
            "reported_zip_code": ZIP,
            "latitude": f"concat(cast(25 + o_custkey % 25 as string), '.', {pad('(o_custkey * 37) % 1000000', 6)})",
            "longitude": dirty(
                "o_orderkey % 59 = 0",
                "'west'",
                f"concat('-', cast(67 + o_custkey % 57 as string), '.', {pad('(o_custkey * 91) % 1000000', 6)})",
            ),
            "occupancy_type": pick("o_orderkey", ["1", "2", "3", "4"]),
            "construction_type": pick("o_custkey", ["Frame", "Masonry", "Steel", "Concrete"]),
            "year_built": "cast(1950 + o_custkey % 74 as string)",
            "number_of_floors": dirty(
                "o_orderkey % 71 = 0", "'two'", "cast(1 + o_orderkey % 3 as string)"
            ),
            "building_value": amount(f"{PRICE} * 5"),
            "contents_value": amount(f"{PRICE} * 2"),
            "total_building_coverage": dirty(
                "o_custkey % 37 = 0",
                f"concat('-', {amount(f'{PRICE} * 4')})",
                amount(f"{PRICE} * 4"),
            ),
            "total_contents_coverage": amount(f"{PRICE} * 1.4"),
            "deductible_amount": pick("o_orderkey", ["500.0", "1000.0", "2500.0", "5000.0"]),
            "flood_zone": pick("o_custkey", ["A", "AE", "V", "X", "B", "C"]),
            "primary_residence": dirty("o_orderkey % 10 < 3", "'false'", "'true'"),
        },
    ),
    "workers_comp_policies_csv": (
        "WC",
        {
            **policy_columns("WC", "WC", 365),
            "employer_name": dirty(
                "o_custkey % 17 = 0", "null", "concat('  Employer_', cast(o_custkey as string))"
            ),
            "fein": f"concat({pad('o_custkey % 99', 2)}, '-', {pad('o_custkey * 13', 7)})",
            "naics_code": pad("(o_custkey * 31) % 999999", 6),
            "class_code": pick("o_orderkey", ["8810", "8742", "5191", "5183", "8017"]),
            "state_code": DIRTY_STATE,
            "payroll_amount": dirty(
                "o_custkey % 37 = 0", f"concat('-', {amount(f'{PRICE} * 20')})", amount(f"{PRICE} * 20")
            ),
            "experience_mod_factor": "concat(cast(o_custkey % 2 as string), '.', "
            + pad("o_orderkey % 1000", 3)
            + ")",
        },
    ),
    "auto_policies_csv": (
        "AUTO",
        {
            **policy_columns("AUTO", "AU", 180),
            "insured_dob": f"cast({ORDER_DAY} + cast(-9000 - o_custkey % 9000 as int) as string)",
            "insured_gender": pick("o_custkey", ["M", "f "]),
            "vehicle_year": "cast(1960 + o_orderkey % 75 as string)",
            "vehicle_make": pick("o_orderkey", ["Toyota", "Honda", " Ford", "BMW ", "Tesla"]),
            "vehicle_model": pick("o_custkey", ["Sedan", "SUV", "Truck", "Coupe"]),
            "vin": f"concat('1hgbh41jxmn', {pad('o_orderkey % 999999', 6)})",
            "garage_state": DIRTY_STATE,
            "garage_zip": ZIP,
            "coverage_type": pick("o_orderkey", ["Comprehensive", "Collision", "Liability"]),
            "liability_limit": pick("o_custkey", ["25000.0", "50000.0", "100000.0", "1e5"]),
            "deductible_amount": pick("o_orderkey", ["250.0", "500.0", "1000.0", "2000.0"]),
            "address": STREET,
            "city": CITY,
            "state": DIRTY_STATE,
            "zip_code": ZIP,
        },
    ),
    "general_liability_policies_csv": (
        "GL",
        {
            **policy_columns("GL", "GL", 365),
            "business_type": pick("o_custkey", ["Restaurant", "Retail", "Construction"]),
            "naics_code": pad("(o_custkey * 31) % 999999", 6),
            "class_code": pad("(o_custkey * 17) % 99999", 5),
            "state_code": DIRTY_STATE,
            "revenue": amount(f"{PRICE} * 50"),
            "occurrence_limit": dirty(
                "o_custkey % 37 = 0", "'-1000000.0'", pick("o_orderkey", ["500000.0", "1000000.0"])
            ),
            "aggregate_limit": pick("o_orderkey", ["1000000.0", "2000000.0"]),
            "deductible_amount": pick("o_orderkey", ["1000.0", "2500.0", "5000.0"]),
            "address": STREET,
            "city": CITY,
            "state": DIRTY_STATE,
            "zip_code": ZIP,
        },
    ),
    "umbrella_policies_csv": (
        "UMB",
        {
            **policy_columns("UMB", "UB", 365),
            "insured_type": pick("o_custkey", ["Individual", "Commercial"]),
            "umbrella_limit": pick("o_orderkey", ["1000000.0", "2000000.0", "5000000.0"]),
            "retention_amount": dirty(
                "o_custkey % 37 = 0", "'-5000.0'", pick("o_orderkey", ["0.0", "5000.0"])
            ),
            "underlying_auto_policy_id": f"concat('AUTO-', {pad('o_orderkey + 1', 10)})",
            "underlying_gl_policy_id": f"concat('GL-', {pad('o_orderkey + 2', 10)})",
            "underlying_wc_policy_id": f"concat('WC-', {pad('o_orderkey + 3', 10)})",
            "state_code": DIRTY_STATE,
            "city": CITY,
            "zip_code": ZIP,
        },
    ),
}

CLAIM_TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "property_claims_csv": (
        "PROP",
        {
            **claim_columns("PROP", "PROP", "date_of_loss"),
            "year_of_loss": dirty(
                "l_partkey % 3 = 0", "null", f"cast(year({SHIP_DAY}) as string)"
            ),
            "state": pick("l_suppkey", ["tx", " CA", "NY "]),
            "reported_city": "concat('City_', cast(l_suppkey % 1000 as string))",
            "reported_zip_code": pad("l_partkey % 99999", 5),
            "cause_of_damage": pick("l_partkey", ["Fire", "Wind", "Water", "Hail", "Theft"]),
            "amount_paid_building": dirty(
                "l_suppkey % 37 = 0",
                f"concat('-', {amount(f'{EXTENDED} * {DISCOUNT}')})",
                amount(f"{EXTENDED} * {DISCOUNT}"),
            ),
            "amount_paid_contents": amount(f"{EXTENDED} * {TAX}"),
            "building_damage_amount": amount(f"{EXTENDED} * 0.5"),
            "contents_damage_amount": amount(f"{EXTENDED} * 0.25"),
        },
    ),
    "workers_comp_claims_json": (
        "WC",
        {
            **claim_columns("WC", "WC", "date_of_injury"),
            "injury_type": pick("l_partkey", ["Strain", "Sprain", "Fracture", "Burn"]),
            "body_part": pick("l_suppkey", ["Back", "Knee", "Hand"]),
            "nature_of_injury": pick("l_partkey", ["Strain", "Sprain", "Fracture", "Burn"]),
            "cause_of_injury": pick("l_suppkey", ["Lifting", "Fall", "Slip", "Struck_By"]),
            "employee_age": dirty(
                "l_partkey % 73 = 0", "'unknown'", "cast(18 + l_partkey % 45 as string)"
            ),
            "employee_gender": pick("l_suppkey", ["m", " F"]),
            "medical_paid": dirty(
                "l_partkey % 31 = 0", "null", amount(f"{EXTENDED} * {DISCOUNT}")
            ),
            "indemnity_paid": amount(f"{EXTENDED} * {TAX}"),
            "total_incurred": amount(f"{EXTENDED} * ({DISCOUNT} + {TAX})"),
            "return_to_work_date": dirty(
                "l_returnflag = 'R'",
                f"cast({SHIP_DAY} + cast(l_partkey % 180 as int) as string)",
                "null",
            ),
        },
    ),
    "auto_claims_csv": (
        "AUTO",
        {
            **claim_columns("AUTO", "AUTO", "date_of_accident"),
            "accident_description": pick(
                "l_partkey", ["Rear-end collision", "Hit and run", "Parking lot incident"]
            ),
            "fault_indicator": pick("l_suppkey", ["At_Fault", "Not_At_Fault", "Shared"]),
            "number_vehicles_involved": "cast(1 + l_suppkey % 3 as string)",
            "bodily_injury_count": "cast(l_partkey % 4 as string)",
            "property_damage_amount": amount(f"{EXTENDED} * {TAX}"),
            "total_claim_amount": amount(f"{EXTENDED} * 0.3"),
        },
    ),
    "general_liability_claims_json": (
        "GL",
        {
            **claim_columns("GL", "GL", "date_of_occurrence"),
            "claim_type": pick(
                "l_partkey",
                ["BodilyInjury", "PropertyDamage", "PersonalInjury", "Advertising", "Slander"],
            ),
            "claim_description": "concat('GL incident #', cast(l_partkey as string))",
            "claimant_name": "concat(' Claimant_', cast(l_suppkey as string))",
            "incurred_amount": amount(EXTENDED),
            "paid_amount": amount(f"{EXTENDED} * {DISCOUNT}"),
            "reserve_amount": amount(f"{EXTENDED} * (1 - {DISCOUNT})"),
            "litigation_flag": pick("l_partkey", ["true", "false", "no", "maybe"]),
        },
    ),
    "umbrella_claims_csv": (
        "UMB",
        {
            **claim_columns("UMB", "UMB", "date_of_occurrence"),
            "underlying_line": pick(
                "l_partkey", ["Auto", "GeneralLiability", "WorkersComp", "Boat"]
            ),
            "underlying_claim_id": f"concat('CLM-UND-', {pad('l_partkey', 10)})",
            "excess_amount": amount(f"{EXTENDED} * 0.1"),
            "total_claim_amount": amount(f"{EXTENDED} * 0.2"),
        },
    ),
}


def _second_delivery(columns: dict[str, str], key: str, number: str, changed: str) -> dict[str, str]:
    """The same rows through another feed: newer for some keys, one text changed, the
    amounts as numbers instead of text."""
    arrived = columns["_ingestion_timestamp"]
    return {
        **columns,
        changed: f"concat({columns[changed]}, '_json')",
        number: f"try_cast({columns[number]} as decimal(18,2))",
        "_ingestion_timestamp": f"case when {key} % 2 = 0 then {arrived} + interval '1' day "
        f"else {arrived} - interval '1' day end",
    }


for _name in ("property", "auto", "umbrella"):
    _code, _columns = POLICY_TABLES[f"{_name}_policies_csv"]
    POLICY_TABLES[f"{_name}_policies_json"] = (
        _code,
        _second_delivery(_columns, "o_orderkey", "premium_amount", "underwriter"),
    )
CLAIM_TABLES["property_claims_json"] = (
    "PROP",
    _second_delivery(
        CLAIM_TABLES["property_claims_csv"][1],
        "l_partkey",
        "amount_paid_contents",
        "cause_of_damage",
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Bronze table as a lazy frame over the order and line-item files."""
    orders = table(spark, sf_dir, "orders")
    if name in POLICY_TABLES:
        code, columns = POLICY_TABLES[name]
        rows = orders.filter(orders.o_orderpriority == PRIORITY[code])
    else:
        code, columns = CLAIM_TABLES[name]
        mine = orders.filter(orders.o_orderpriority == PRIORITY[code]).select("o_orderkey")
        lines = table(spark, sf_dir, "lineitem")
        rows = lines.join(mine, lines.l_orderkey == mine.o_orderkey)
    return rows.selectExpr(*[f"{sql} AS {c}" for c, sql in columns.items()])


class SharedLines:
    """The Bronze tables of one run: calling it with a name gives :func:`bronze_frame`'s rows.

    The line items meet their orders once for all claim tables and lie by priority in a scratch
    folder, so they are shuffled once and not once per table.  ``release`` removes the folder.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._lock, self._found = threading.Lock(), None
        self._path = scratch_path(spark, "lines")

    def __call__(self, name: str) -> DataFrame:
        if name not in CLAIM_TABLES:
            return bronze_frame(self.spark, self.sf_dir, name)
        code, columns = CLAIM_TABLES[name]
        lines = self._lines()
        rows = lines.filter(lines.o_orderpriority == PRIORITY[code])
        return rows.selectExpr(*[f"{sql} AS {c}" for c, sql in columns.items()])

    def _lines(self) -> DataFrame:
        with self._lock:
            if self._found is None:
                orders = table(self.spark, self.sf_dir, "orders")
                mine = orders.filter(orders.o_orderpriority.isin([*PRIORITY.values()]))
                lines = table(self.spark, self.sf_dir, "lineitem")
                texts = " ".join(sql for _, columns in CLAIM_TABLES.values() for sql in columns.values())
                used = [c for c in lines.columns if re.search(rf"\b{c}\b", texts)]
                joined = lines.join(
                    mine.select("o_orderkey", "o_orderpriority"), lines.l_orderkey == mine.o_orderkey
                ).select(*used, "o_orderpriority")
                writer = joined.write.option("compression", COMPRESSION).partitionBy("o_orderpriority")
                writer.parquet(self._path)
                self._found = self.spark.read.schema(joined.schema).parquet(self._path)
            return self._found

    def release(self) -> None:
        with self._lock:
            self._found = None
            remove_folder(self.spark, self._path)


def bronze_sql(name: str) -> str:
    """The same table as SQL text."""
    if name in POLICY_TABLES:
        code, columns = POLICY_TABLES[name]
        source = f"orders WHERE o_orderpriority = '{PRIORITY[code]}'"
    else:
        code, columns = CLAIM_TABLES[name]
        source = (
            "lineitem JOIN orders ON l_orderkey = o_orderkey "
            f"WHERE o_orderpriority = '{PRIORITY[code]}'"
        )
    return f"SELECT {', '.join(f'{sql} AS {c}' for c, sql in columns.items())} FROM {source}"


BRONZE_TABLES = (*POLICY_TABLES, *CLAIM_TABLES)


def land_files(spark: SparkSession, sf_dir: str, base: str) -> None:
    """The derived tables as files in the folders and formats of the manifest.

    JSON repeats every column's name in every row, so its files are compressed; CSV files are
    plain, as byte ranges of them are read.
    """
    writers = {"csv": write_csv, "json": partial(write_json_lines, compression="gzip")}
    feed = SharedLines(spark, sf_dir)
    with shuffles_removed(spark):
        for source in (*STRUCTURED, *SEMI_STRUCTURED):
            if source.table in BRONZE_TABLES:
                arrived = feed(source.table).drop("_ingestion_timestamp")
                writers[source.fmt](arrived, f"{base}/{source.path}")
    feed.release()
