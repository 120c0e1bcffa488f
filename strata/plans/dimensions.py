"""Gold dimensions.

Every dimension key is a hash of its natural key.  ``dim_policy`` therefore computes its
foreign keys without any join when it is built from the same Silver tables as the
dimensions it refers to (each referenced row then exists by construction).  Pass ``lookups``
to resolve against given tables instead; a table missing there gives NULL keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import (
    content_id,
    date_to_key,
    foreign_key,
    stable_label,
    surrogate_key,
)
from strata.functions.casts import typed_null
from strata.operators.dedup import deduplicate
from strata.operators.joins import constant_lookup, resolve_key
from strata.operators.sets import union_all
from strata.operators.shaping import conform
from strata.sources.readers import date_series, literal_relation
from strata.specs.gold import gold_schema
from strata.specs.lines import LINES, Line
from strata.specs.reference import (
    COMMISSION_TIERS,
    COVERAGES,
    LINES_OF_BUSINESS,
    PROFESSIONS,
    RISK_TIERS,
    US_STATES,
)

Silver = dict[str, DataFrame]
ADDRESS = ("address_line1", "city", "state_code", "zip_code")


def _typed(name: str, mapping: dict[str, str], skip: Sequence[str] = ()) -> list[Column]:
    """Columns of a Gold table from a mapping; what it leaves out is typed NULL."""
    return [
        (F.expr(mapping[f.name]).cast(f.dataType) if f.name in mapping else typed_null(f.dataType))
        .alias(f.name)
        for f in gold_schema(name).fields
        if f.name not in skip
    ]


def line_location_id(line: Line) -> Column:
    """Content id of a policy's address; NULL for a line without addresses."""
    if line.location is None:
        return typed_null("string")
    return content_id(*[F.expr(line.location.get(c, "cast(null as string)")) for c in ADDRESS])


def dim_date(
    spark: SparkSession, first: date = date(1970, 1, 1), last: date = date(2035, 12, 31)
) -> DataFrame:
    """One row per day; the fiscal year starts in October and no holidays are marked."""
    day = F.col("full_date")
    # October opens the next fiscal year: the civil calendar three months ahead.
    fiscal = F.add_months(day, 3)
    return date_series(spark, first, last, "full_date").select(
        date_to_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.year(fiscal).alias("fiscal_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
    )


def dim_line_of_business(
    spark: SparkSession, rows: Sequence[tuple] = LINES_OF_BUSINESS
) -> DataFrame:
    ddl = """lob_code string, lob_name string, lob_category string,
    regulatory_body string, naic_code string"""
    df = literal_relation(spark, rows, ddl)
    return conform(
        df.withColumn("lob_key", surrogate_key("lob_code")), gold_schema("dim_line_of_business")
    )


def dim_coverage(
    spark: SparkSession, lines: DataFrame | None = None, rows: Sequence[tuple] = COVERAGES
) -> DataFrame:
    """Coverages with the key of their line, joined from ``lines`` (default: the literals)."""
    ddl = """lob_code string, coverage_id string, coverage_code string,
    coverage_name string, coverage_type string, coverage_description string,
    is_mandatory boolean"""
    lines = dim_line_of_business(spark) if lines is None else lines
    df = literal_relation(spark, rows, ddl)
    df = resolve_key(df, "lob_code", lines, "lob_code", ["lob_key"], validate=False)
    return conform(
        df.withColumn("coverage_key", surrogate_key("coverage_id")), gold_schema("dim_coverage")
    )


def dim_profession(spark: SparkSession, states: Sequence[tuple] = US_STATES) -> DataFrame:
    """Professions per licensing state; both factors are literals of fixed size."""
    ddl = """profession_type string, profession_category string,
    requires_board_cert boolean, avg_claim_severity string"""
    codes = F.explode(F.array(*[F.lit(code) for code, _ in states]))
    df = literal_relation(spark, PROFESSIONS, ddl).withColumn("license_state", codes)
    df = df.withColumn("profession_id", F.concat_ws("_", "profession_type", "license_state"))
    key = surrogate_key("profession_type", "license_state")
    return conform(df.withColumn("profession_key", key), gold_schema("dim_profession"))


def dim_insured(silver: Silver, lines: Sequence[Line] = LINES) -> DataFrame | None:
    """One insured per policy id, in the shape of its line."""
    frames = [
        silver[line.policies.name].select(
            F.col("policy_id").alias("insured_id"),
            *_typed("dim_insured", line.insured, skip=("insured_key", "insured_id")),
        )
        for line in lines
        if line.policies.name in silver
    ]
    df = union_all(frames)
    if df is None:
        return None
    df = deduplicate(df, ["insured_id"], "insured_name", ascending=True)
    return conform(
        df.withColumn("insured_key", surrogate_key("insured_id")), gold_schema("dim_insured")
    )


def dim_location(silver: Silver, lines: Sequence[Line] = LINES) -> DataFrame | None:
    """One row per distinct address, city, state and zip."""
    skip = ("location_key", "location_id", "state_name", "country", "territory_code")
    frames = [
        silver[line.policies.name].select(
            line_location_id(line).alias("location_id"),
            *_typed("dim_location", line.location, skip),
        )
        for line in lines
        if line.location is not None and line.policies.name in silver
    ]
    df = union_all(frames)
    if df is None:
        return None
    df = deduplicate(df, ["location_id"], "city", ascending=True)
    df = constant_lookup(df, "state_code", US_STATES, "state_name")
    df = df.select(
        "*",
        surrogate_key("location_id").alias("location_key"),
        F.lit("US").alias("country"),
        F.col("state_code").alias("territory_code"),
    )
    return conform(df, gold_schema("dim_location"))


def dim_agent(silver: Silver, lines: Sequence[Line] = LINES) -> DataFrame | None:
    frames = [
        silver[line.policies.name]
        .filter("agent_id IS NOT NULL")
        .select("agent_id", "agent_name", F.col(line.agent_state).alias("state_code"))
        for line in lines
        if line.policies.name in silver
    ]
    df = union_all(frames)
    if df is None:
        return None
    df = deduplicate(df, ["agent_id"], "agent_name", ascending=True)
    agency = F.substring("agent_id", 5, 6)
    return conform(
        df.select(
            "*",
            surrogate_key("agent_id").alias("agent_key"),
            F.concat(F.lit("Agency_"), agency).alias("agency_name"),
            agency.alias("agency_code"),
            F.concat(F.lit("LIC-"), "agent_id").alias("license_number"),
            stable_label("agent_id", COMMISSION_TIERS).alias("commission_tier"),
        ),
        gold_schema("dim_agent"),
    )


def dim_policy(
    silver: Silver,
    lines: Sequence[Line] = LINES,
    lookups: dict[str, DataFrame] | None = None,
) -> DataFrame | None:
    """One row per policy id: the version with the latest effective date."""
    frames = [
        silver[line.policies.name].select(
            "policy_id",
            "policy_number",
            F.lit(line.code).alias("lob_code"),
            "agent_id",
            line_location_id(line).alias("location_id"),
            "effective_date",
            "expiration_date",
            "underwriter",
        )
        for line in lines
        if line.policies.name in silver
    ]
    df = union_all(frames)
    if df is None:
        return None
    df = deduplicate(df, ["policy_id"], "effective_date")
    if lookups is None:
        df = df.select(
            "*",
            surrogate_key("lob_code").alias("lob_key"),
            surrogate_key("policy_id").alias("insured_key"),
            foreign_key("agent_id").alias("agent_key"),
            foreign_key("location_id").alias("location_key"),
        )
    else:
        spread = ["policy_id"]
        for column, table, natural, key in (
            ("lob_code", "dim_line_of_business", "lob_code", "lob_key"),
            ("policy_id", "dim_insured", "insured_id", "insured_key"),
            ("agent_id", "dim_agent", "agent_id", "agent_key"),
            ("location_id", "dim_location", "location_id", "location_key"),
        ):
            lookup = lookups.get(table)
            df = resolve_key(df, column, lookup, natural, [key], False, spread)
    term = F.months_between("expiration_date", "effective_date").cast("int")
    return conform(
        df.select(
            "*",
            surrogate_key("policy_id").alias("policy_key"),
            date_to_key("effective_date").alias("effective_date_key"),
            date_to_key("expiration_date").alias("expiration_date_key"),
            F.lit("Active").alias("policy_status"),
            term.alias("policy_term_months"),
            stable_label("policy_id", RISK_TIERS).alias("risk_tier"),
            F.lit(False).alias("is_renewal"),
        ),
        gold_schema("dim_policy"),
    )


def dim_claim(
    silver: Silver, policies: DataFrame | None, lines: Sequence[Line] = LINES
) -> DataFrame | None:
    """One row per claim id: the version with the latest loss date."""
    frames = []
    for line in lines:
        if line.claims.name not in silver:
            continue
        mapping = {"litigation_flag": "false", "claim_status": "claim_status", **line.claim}
        loss = F.expr(mapping.pop("date_of_loss"))
        taken = {f.name for f in gold_schema("dim_claim").fields} - {*mapping, "claimant_name"}
        frames.append(
            silver[line.claims.name].select(
                "claim_id",
                "policy_id",
                loss.alias("date_of_loss"),
                *_typed("dim_claim", mapping, skip=tuple(taken)),
            )
        )
    df = union_all(frames)
    if df is None:
        return None
    df = deduplicate(df, ["claim_id"], "date_of_loss")
    df = resolve_key(
        df, "policy_id", policies, "policy_id", ["policy_key"], False, ["claim_id"]
    )
    # The loss is the only date the sources carry, so it is the reporting date too.
    return conform(
        df.select(
            "*",
            surrogate_key("claim_id").alias("claim_key"),
            F.col("claim_id").alias("claim_number"),
            date_to_key("date_of_loss").alias("date_of_loss_key"),
            date_to_key("date_of_loss").alias("date_reported_key"),
        ),
        gold_schema("dim_claim"),
    )
