"""Lines of business as data: Silver columns, checks, sources and Gold mappings.

Adding a line means adding entries here; no builder names a line.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from strata.operators.shaping import schema_of

AUDIT_DDL = "_is_valid boolean, _dq_issues string, _ingestion_timestamp timestamp"


@dataclass(frozen=True)
class TableSpec:
    """A Silver table: columns, key, text in upper case, checks and its Bronze sources."""

    name: str
    key: str
    ddl: str
    sources: tuple[str, ...]
    # (check, column, check name or None, argument)
    checks: tuple[tuple, ...]
    upper: tuple[str, ...] = ()
    # column -> SQL over the *typed* columns, evaluated after the casts
    derived: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> T.StructType:
        return schema_of(self.ddl)

    @property
    def schema(self) -> T.StructType:
        """Full Silver schema: the key is not nullable, audit columns come last."""
        fields = [
            T.StructField(f.name, f.dataType, f.name != self.key) for f in self.columns.fields
        ]
        return T.StructType([*fields, *schema_of(AUDIT_DDL).fields])


@dataclass(frozen=True)
class Line:
    """A line of business: its two Silver tables and how they map to the star schema.

    The mapping values are SQL expressions over the Silver columns.
    """

    code: str
    policies: TableSpec
    claims: TableSpec
    insured: dict[str, str]
    agent_state: str
    coverage_id: str
    coverage_limit: str
    deductible: str
    claim: dict[str, str]
    paid: str
    reserve: str
    location: dict[str, str] | None
    # mart column -> Silver column
    attributes: dict[str, str]
    transaction_type: str = "'payment'"
    expense: str = "0"


# ----------------------------------------------------------------------------------------
# Silver columns and types, check names and allowed values, source tables.
# ----------------------------------------------------------------------------------------

PROPERTY_POLICIES = TableSpec(
    "property_policies",
    "policy_id",
    """policy_id string, policy_number string, effective_date date, expiration_date date,
    insured_name string, property_state string, reported_city string,
    reported_zip_code string, latitude double, longitude double, occupancy_type string,
    construction_type string, year_built int, number_of_floors int, flood_zone string,
    total_building_coverage decimal(18,2), total_contents_coverage decimal(18,2),
    building_value decimal(18,2), contents_value decimal(18,2),
    premium_amount decimal(18,2), deductible_amount decimal(18,2),
    primary_residence boolean, agent_id string, agent_name string, underwriter string""",
    ("property_policies_csv", "property_policies_json"),
    (
        ("not_null", "policy_id", None),
        ("not_null", "property_state", "missing_state"),
        ("positive", "total_building_coverage", None),
        ("positive", "premium_amount", None),
    ),
    upper=("property_state",),
)

PROPERTY_CLAIMS = TableSpec(
    "property_claims",
    "claim_id",
    """claim_id string, policy_id string, date_of_loss date, year_of_loss int, state string,
    reported_city string, reported_zip_code string, cause_of_damage string,
    amount_paid_building decimal(18,2), amount_paid_contents decimal(18,2),
    building_damage_amount decimal(18,2), contents_damage_amount decimal(18,2),
    claim_status string""",
    ("property_claims_csv", "property_claims_json"),
    (
        ("not_null", "claim_id", None),
        ("not_null", "date_of_loss", "missing_loss_date"),
        ("positive", "amount_paid_building", None),
    ),
    upper=("state",),
    derived={"year_of_loss": "coalesce(year_of_loss, year(date_of_loss))"},
)

WORKERS_COMP_POLICIES = TableSpec(
    "workers_comp_policies",
    "policy_id",
    """policy_id string, policy_number string, effective_date date, expiration_date date,
    employer_name string, insured_name string, fein string, naics_code string,
    class_code string, state_code string, payroll_amount decimal(18,2),
    experience_mod_factor decimal(6,3), premium_amount decimal(18,2), agent_id string,
    agent_name string, underwriter string""",
    ("workers_comp_policies_csv",),
    (
        ("not_null", "policy_id", None),
        ("not_null", "employer_name", "missing_employer"),
        ("not_null", "state_code", "missing_state"),
        ("positive", "payroll_amount", None),
        ("positive", "premium_amount", None),
    ),
    upper=("state_code",),
    derived={"insured_name": "coalesce(insured_name, employer_name)"},
)

WORKERS_COMP_CLAIMS = TableSpec(
    "workers_comp_claims",
    "claim_id",
    """claim_id string, policy_id string, date_of_injury date, injury_type string,
    body_part string, nature_of_injury string, cause_of_injury string, employee_age int,
    employee_gender string, medical_paid decimal(18,2), indemnity_paid decimal(18,2),
    total_incurred decimal(18,2), claim_status string, return_to_work_date date""",
    ("workers_comp_claims_json",),
    (
        ("not_null", "claim_id", None),
        ("not_null", "date_of_injury", "missing_injury_date"),
        ("in_set", "claim_status", None, ("Open", "Closed", "Reopened", "Pending")),
    ),
    upper=("employee_gender",),
)

AUTO_POLICIES = TableSpec(
    "auto_policies",
    "policy_id",
    """policy_id string, policy_number string, effective_date date, expiration_date date,
    insured_name string, insured_dob date, insured_gender string, vehicle_year int,
    vehicle_make string, vehicle_model string, vin string, garage_state string,
    garage_zip string, coverage_type string, liability_limit decimal(18,2),
    deductible_amount decimal(18,2), premium_amount decimal(18,2), agent_id string,
    agent_name string, underwriter string, address string, city string, state string,
    zip_code string""",
    ("auto_policies_csv", "auto_policies_json"),
    (
        ("not_null", "policy_id", None),
        ("not_null", "insured_name", "missing_insured"),
        ("positive", "premium_amount", None),
    ),
    upper=("insured_gender", "vin", "garage_state", "state"),
)

AUTO_CLAIMS = TableSpec(
    "auto_claims",
    "claim_id",
    """claim_id string, policy_id string, date_of_accident date,
    accident_description string, fault_indicator string, number_vehicles_involved int,
    bodily_injury_count int, property_damage_amount decimal(18,2),
    total_claim_amount decimal(18,2), claim_status string""",
    ("auto_claims_csv",),
    (
        ("not_null", "claim_id", None),
        ("not_null", "date_of_accident", "missing_accident_date"),
    ),
)

GENERAL_LIABILITY_POLICIES = TableSpec(
    "general_liability_policies",
    "policy_id",
    """policy_id string, policy_number string, effective_date date, expiration_date date,
    insured_name string, business_type string, naics_code string, class_code string,
    state_code string, revenue decimal(18,2), premium_amount decimal(18,2),
    occurrence_limit decimal(18,2), aggregate_limit decimal(18,2),
    deductible_amount decimal(18,2), agent_id string, agent_name string,
    underwriter string, address string, city string, state string, zip_code string""",
    ("general_liability_policies_csv",),
    (
        ("not_null", "policy_id", None),
        ("not_null", "insured_name", "missing_insured"),
        ("positive", "occurrence_limit", None),
        ("positive", "premium_amount", None),
    ),
    upper=("state_code", "state"),
)

GENERAL_LIABILITY_CLAIMS = TableSpec(
    "general_liability_claims",
    "claim_id",
    """claim_id string, policy_id string, date_of_occurrence date, claim_type string,
    claim_description string, claimant_name string, incurred_amount decimal(18,2),
    paid_amount decimal(18,2), reserve_amount decimal(18,2), claim_status string,
    litigation_flag boolean""",
    ("general_liability_claims_json",),
    (
        ("not_null", "claim_id", None),
        (
            "in_set",
            "claim_type",
            None,
            (
                "BodilyInjury",
                "PropertyDamage",
                "PersonalInjury",
                "Advertising",
                "ProductLiability",
            ),
        ),
    ),
)

UMBRELLA_POLICIES = TableSpec(
    "umbrella_policies",
    "policy_id",
    """policy_id string, policy_number string, effective_date date, expiration_date date,
    insured_name string, insured_type string, umbrella_limit decimal(18,2),
    retention_amount decimal(18,2), premium_amount decimal(18,2),
    underlying_auto_policy_id string, underlying_gl_policy_id string,
    underlying_wc_policy_id string, agent_id string, agent_name string,
    underwriter string, state_code string, city string, zip_code string""",
    ("umbrella_policies_csv", "umbrella_policies_json"),
    (
        ("not_null", "policy_id", None),
        ("not_null", "insured_name", "missing_insured"),
        ("positive", "umbrella_limit", None),
        ("positive", "retention_amount", None),
    ),
    upper=("state_code",),
)

UMBRELLA_CLAIMS = TableSpec(
    "umbrella_claims",
    "claim_id",
    """claim_id string, policy_id string, date_of_occurrence date, underlying_line string,
    underlying_claim_id string, excess_amount decimal(18,2),
    total_claim_amount decimal(18,2), claim_status string""",
    ("umbrella_claims_csv",),
    (
        ("not_null", "claim_id", None),
        (
            "in_set",
            "underlying_line",
            None,
            ("Auto", "GeneralLiability", "WorkersComp", "EmployersLiability"),
        ),
    ),
)

PROFESSIONAL_POLICIES = TableSpec(
    "professional_liability_policies",
    "policy_id",
    """policy_id string, policy_number string, effective_date date, expiration_date date,
    insured_name string, profession_type string, license_number string, state_code string,
    retroactive_date date, per_claim_limit decimal(18,2), aggregate_limit decimal(18,2),
    deductible_amount decimal(18,2), premium_amount decimal(18,2), agent_id string,
    agent_name string, underwriter string""",
    ("professional_liability_policies_csv",),
    (
        ("not_null", "policy_id", None),
        ("not_null", "insured_name", "missing_insured"),
        ("positive", "premium_amount", None),
        ("less_equal", "per_claim_limit", None, "aggregate_limit"),
        ("less_equal", "effective_date", None, "expiration_date"),
    ),
    upper=("state_code",),
)

PROFESSIONAL_CLAIMS = TableSpec(
    "professional_liability_claims",
    "claim_id",
    """claim_id string, policy_id string, date_of_occurrence date,
    claim_description string, claimant_name string, claimed_amount decimal(18,2),
    paid_amount decimal(18,2), claim_status string""",
    ("professional_liability_claims_csv",),
    (
        ("not_null", "claim_id", None),
        ("less_equal", "paid_amount", None, "claimed_amount"),
        ("in_set", "claim_status", None, ("Open", "Closed", "Pending", "Denied")),
    ),
)


# ----------------------------------------------------------------------------------------
# How each line's columns map to the star schema.
# ----------------------------------------------------------------------------------------

PROPERTY = Line(
    "PROP",
    PROPERTY_POLICIES,
    PROPERTY_CLAIMS,
    insured={"insured_name": "concat('Insured_', policy_id)", "insured_type": "'Individual'"},
    agent_state="property_state",
    coverage_id="COV-PROP-BLDG",
    coverage_limit="total_building_coverage",
    deductible="deductible_amount",
    claim={
        "claimant_type": "'Policyholder'",
        "date_of_loss": "date_of_loss",
        "cause_of_loss": "cause_of_damage",
        "claim_type": "'Property'",
    },
    paid="amount_paid_building",
    reserve="building_damage_amount",
    location={
        "city": "reported_city",
        "state_code": "property_state",
        "zip_code": "reported_zip_code",
        "latitude": "latitude",
        "longitude": "longitude",
        "flood_zone": "flood_zone",
    },
    attributes={
        "property_construction_type": "construction_type",
        "property_occupancy_type": "occupancy_type",
        "property_floors": "number_of_floors",
        "property_building_value": "total_building_coverage",
        "property_contents_value": "total_contents_coverage",
    },
)

WORKERS_COMP = Line(
    "WC",
    WORKERS_COMP_POLICIES,
    WORKERS_COMP_CLAIMS,
    insured={
        "insured_name": "employer_name",
        "insured_type": "'Commercial'",
        "ein": "fein",
        "naics_code": "naics_code",
    },
    agent_state="state_code",
    coverage_id="COV-WC-MED",
    coverage_limit="payroll_amount",
    deductible="0",
    claim={
        "claimant_type": "'Employee'",
        "date_of_loss": "date_of_injury",
        "cause_of_loss": "cause_of_injury",
        "claim_type": "injury_type",
    },
    paid="coalesce(medical_paid, 0) + coalesce(indemnity_paid, 0)",
    reserve="total_incurred",
    location=None,
    attributes={
        "wc_class_code": "class_code",
        "wc_payroll_amount": "payroll_amount",
        "wc_experience_mod": "experience_mod_factor",
    },
)

AUTO = Line(
    "AUTO",
    AUTO_POLICIES,
    AUTO_CLAIMS,
    insured={
        "insured_name": "insured_name",
        "insured_type": "'Individual'",
        "date_of_birth": "insured_dob",
        "gender": "insured_gender",
    },
    agent_state="state",
    coverage_id="COV-AUTO-BI",
    coverage_limit="liability_limit",
    deductible="deductible_amount",
    claim={
        "claimant_type": "'Driver'",
        "date_of_loss": "date_of_accident",
        "cause_of_loss": "accident_description",
        "claim_type": "'Auto'",
    },
    paid="total_claim_amount",
    reserve="property_damage_amount",
    location={
        "address_line1": "address",
        "city": "city",
        "state_code": "garage_state",
        "zip_code": "garage_zip",
    },
    attributes={
        "auto_vehicle_year": "vehicle_year",
        "auto_vehicle_make": "vehicle_make",
        "auto_vehicle_model": "vehicle_model",
        "auto_vin": "vin",
        "auto_garage_state": "garage_state",
    },
)

GENERAL_LIABILITY = Line(
    "GL",
    GENERAL_LIABILITY_POLICIES,
    GENERAL_LIABILITY_CLAIMS,
    insured={
        "insured_name": "insured_name",
        "insured_type": "'Commercial'",
        "naics_code": "naics_code",
        "industry": "business_type",
        "annual_revenue": "revenue",
    },
    agent_state="state_code",
    coverage_id="COV-GL-PREM",
    coverage_limit="occurrence_limit",
    deductible="deductible_amount",
    claim={
        "claimant_name": "claimant_name",
        "claimant_type": "'ThirdParty'",
        "date_of_loss": "date_of_occurrence",
        "cause_of_loss": "claim_description",
        "claim_type": "claim_type",
        "litigation_flag": "litigation_flag",
    },
    paid="paid_amount",
    reserve="reserve_amount",
    location={
        "address_line1": "address",
        "city": "city",
        "state_code": "state_code",
        "zip_code": "zip_code",
    },
    attributes={
        "gl_business_type": "business_type",
        "gl_revenue": "revenue",
        "gl_occurrence_limit": "occurrence_limit",
        "gl_aggregate_limit": "aggregate_limit",
    },
)

UMBRELLA = Line(
    "UMB",
    UMBRELLA_POLICIES,
    UMBRELLA_CLAIMS,
    insured={"insured_name": "insured_name", "insured_type": "insured_type"},
    agent_state="state_code",
    coverage_id="COV-UMB-EXCESS",
    coverage_limit="umbrella_limit",
    deductible="retention_amount",
    claim={
        "claimant_type": "'Excess'",
        "date_of_loss": "date_of_occurrence",
        "cause_of_loss": "underlying_line",
        "claim_type": "'Umbrella'",
    },
    paid="excess_amount",
    reserve="total_claim_amount",
    location={"city": "city", "state_code": "state_code", "zip_code": "zip_code"},
    attributes={
        "umb_umbrella_limit": "umbrella_limit",
        "umb_retention_amount": "retention_amount",
        "umb_underlying_auto": "underlying_auto_policy_id",
        "umb_underlying_gl": "underlying_gl_policy_id",
        "umb_underlying_wc": "underlying_wc_policy_id",
    },
)

PROFESSIONAL = Line(
    "PL",
    PROFESSIONAL_POLICIES,
    PROFESSIONAL_CLAIMS,
    insured={"insured_name": "insured_name", "insured_type": "'Commercial'"},
    agent_state="state_code",
    coverage_id="COV-PL-PROF",
    coverage_limit="per_claim_limit",
    deductible="deductible_amount",
    claim={
        "claimant_name": "claimant_name",
        "claimant_type": "'ThirdParty'",
        "date_of_loss": "date_of_occurrence",
        "cause_of_loss": "claim_description",
        "claim_type": "'Professional'",
    },
    paid="paid_amount",
    reserve="coalesce(claimed_amount, 0) - coalesce(paid_amount, 0)",
    location=None,
    attributes={},
    transaction_type="case when paid_amount > 0 then 'Payment' else 'Reserve' end",
    expense="coalesce(paid_amount, 0) * 0.15",
)

LINES = (PROPERTY, WORKERS_COMP, AUTO, GENERAL_LIABILITY, UMBRELLA)
LINES_WITH_PROFESSIONAL = (*LINES, PROFESSIONAL)


def silver_specs(lines: tuple[Line, ...] = LINES) -> list[TableSpec]:
    return [spec for line in lines for spec in (line.policies, line.claims)]
