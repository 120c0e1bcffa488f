"""Declared Gold schemas.

Fixed values: column names, types and order are the output contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

from strata.operators.shaping import schema_of

GOLD_DDL = {
    "dim_date": """date_key int not null, full_date date not null, year int, quarter int,
    month int, month_name string, day int, day_of_week int, day_name string,
    is_weekend boolean, is_holiday boolean, fiscal_year int, fiscal_quarter int""",
    "dim_line_of_business": """lob_key string not null, lob_code string not null,
    lob_name string, lob_category string, regulatory_body string, naic_code string""",
    "dim_insured": """insured_key string not null, insured_id string not null,
    insured_name string, insured_type string, date_of_birth date, gender string,
    ein string, sic_code string, naics_code string, industry string, employee_count int,
    annual_revenue decimal(18,2)""",
    "dim_location": """location_key string not null, location_id string not null,
    address_line1 string, address_line2 string, city string, county string,
    state_code string, state_name string, zip_code string, country string,
    latitude double, longitude double, territory_code string, flood_zone string""",
    "dim_agent": """agent_key string not null, agent_id string not null, agent_name string,
    agency_name string, agency_code string, license_number string, state_code string,
    commission_tier string""",
    "dim_coverage": """coverage_key string not null, coverage_id string not null,
    coverage_code string, coverage_name string, coverage_type string,
    coverage_description string, lob_key string, is_mandatory boolean""",
    "dim_policy": """policy_key string not null, policy_id string not null,
    policy_number string, lob_key string, insured_key string, agent_key string,
    location_key string, effective_date_key int, expiration_date_key int,
    policy_status string, policy_term_months int, underwriter string, risk_tier string,
    is_renewal boolean, original_policy_id string""",
    "dim_claim": """claim_key string not null, claim_id string not null,
    claim_number string, policy_key string, claimant_name string, claimant_type string,
    date_of_loss_key int, date_reported_key int, cause_of_loss string, claim_type string,
    claim_status string, litigation_flag boolean, catastrophe_code string,
    adjuster_name string""",
    "dim_profession": """profession_key string not null, profession_id string not null,
    profession_type string, profession_category string, license_state string,
    requires_board_cert boolean, avg_claim_severity string""",
    "fact_premium": """premium_key string not null, policy_key string, coverage_key string,
    date_key int, lob_key string, location_key string, written_premium decimal(18,2),
    earned_premium decimal(18,2), ceded_premium decimal(18,2), net_premium decimal(18,2),
    deductible_amount decimal(18,2), coverage_limit decimal(18,2),
    commission_amount decimal(18,2), tax_amount decimal(18,2)""",
    "fact_claim_transaction": """claim_txn_key string not null, claim_key string,
    policy_key string, date_key int, lob_key string, transaction_type string,
    paid_amount decimal(18,2), reserve_amount decimal(18,2),
    recovery_amount decimal(18,2), expense_amount decimal(18,2),
    total_incurred decimal(18,2), is_final_payment boolean""",
    "fact_policy_transaction": """policy_txn_key string not null, policy_key string,
    date_key int, lob_key string, transaction_type string, premium_change decimal(18,2),
    effective_date date, processed_date date""",
    "mart_policy_360": """policy_key string, policy_id string, policy_number string,
    effective_date_key int, expiration_date_key int, policy_status string,
    policy_term_months int, risk_tier string, is_renewal boolean, underwriter string,
    lob_key string, lob_code string, lob_name string, lob_category string,
    naic_code string,
    insured_key string, insured_name string, insured_type string, insured_dob date,
    insured_gender string, insured_ein string, insured_naics string,
    insured_industry string, insured_employee_count int,
    insured_annual_revenue decimal(18,2),
    agent_key string, agent_name string, agency_name string, agency_code string,
    commission_tier string,
    location_key string, policy_address string, policy_city string, policy_state string,
    policy_state_name string, policy_zip string, policy_latitude double,
    policy_longitude double, policy_flood_zone string,
    total_written_premium decimal(28,2), total_earned_premium decimal(28,2),
    total_net_premium decimal(28,2), total_coverage_limit decimal(28,2),
    total_deductible decimal(28,2), total_commission decimal(28,2),
    premium_line_count bigint,
    total_claims_count bigint, open_claims_count bigint, closed_claims_count bigint,
    total_paid_amount decimal(28,2), total_reserved_amount decimal(28,2),
    total_incurred decimal(28,2), loss_ratio decimal(24,4), last_claim_date_key int,
    largest_claim_amount decimal(18,2),
    property_construction_type string, property_occupancy_type string,
    property_floors int, property_building_value decimal(18,2),
    property_contents_value decimal(18,2),
    auto_vehicle_year int, auto_vehicle_make string, auto_vehicle_model string,
    auto_vin string, auto_garage_state string,
    wc_class_code string, wc_payroll_amount decimal(18,2),
    wc_experience_mod decimal(6,3), wc_injury_count bigint,
    gl_business_type string, gl_revenue decimal(18,2),
    gl_occurrence_limit decimal(18,2), gl_aggregate_limit decimal(18,2),
    umb_umbrella_limit decimal(18,2), umb_retention_amount decimal(18,2),
    umb_underlying_auto string, umb_underlying_gl string, umb_underlying_wc string,
    policy_tenure_months int, days_until_expiry int, is_active boolean""",
}


def gold_schema(name: str) -> T.StructType:
    return schema_of(GOLD_DDL[name])
