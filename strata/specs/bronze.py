"""Declared Bronze schemas.

Flat files carry a policy and one of its claims per row, all text; their columns follow from
the Silver specs by one rule.  Nested payloads keep maps, structs and arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.operators.shaping import all_strings, schema_of, select_available
from strata.specs.lines import Line

# Columns of the public flood-insurance bulk files.
FLOOD_CLAIMS = """agricultureStructureIndicator asOfDate basementEnclosureCrawlspaceType
reportedCity condominiumIndicator countyCode communityRatingSystemDiscount dateOfLoss
elevatedBuildingIndicator elevationCertificateIndicator elevationDifference floodZone
houseWorship latitude longitude locationOfContents lowestAdjacentGrade lowestFloorElevation
numberOfFloorsInTheInsuredBuilding nonProfitIndicator obstructionType occupancyType
originalConstructionDate originalNBDate amountPaidOnBuildingClaim amountPaidOnContentsClaim
amountPaidOnIncreasedCostOfComplianceClaim postFIRMConstructionIndicator rateMethod
smallBusinessIndicatorBuilding state totalBuildingInsuranceCoverage
totalContentsInsuranceCoverage yearOfLoss reportedZipCode primaryResidence id""".split()

FLOOD_POLICIES = """agricultureStructureIndicator basementEnclosureCrawlspaceType
cancellationDateOfFloodPolicy condominiumIndicator countyCode crsClassCode
deductibleAmountInBuildingCoverage deductibleAmountInContentsCoverage
elevatedBuildingIndicator elevationCertificateIndicator elevationDifference
federalPolicyFee floodZone hfiaaSurcharge houseWorship latitude longitude
locationOfContents lowestAdjacentGrade lowestFloorElevation
numberOfFloorsInTheInsuredBuilding nonProfitIndicator obstructionType occupancyType
originalConstructionDate originalNBDate policyCount policyEffectiveDate
policyTerminationDate policyTermIndicator postFIRMConstructionIndicator primaryResidence
propertyState rateMethod regularEmergencyProgramIndicator reportedCity reportedZipCode
smallBusinessIndicatorBuilding totalBuildingInsuranceCoverage
totalContentsInsuranceCoverage totalInsurancePremiumOfThePolicy id""".split()

# A flat column no Silver table keeps.
FLAT_EXTRA = {"UMB": ["underlying_employers_liability_id"]}

# Nested payload shapes.
PAYLOAD_DDL = {
    "property_claims": """metadata map<string,string>,
    FimaNfipClaims array<map<string,string>>""",
    "workers_comp": """policy_id string, policy_number string,
    employer_info map<string,string>, coverage_details map<string,string>,
    claims array<map<string,string>>, payroll_details array<map<string,string>>""",
    "auto": """policy_id string, policy_number string, insured_info map<string,string>,
    vehicle_info map<string,string>, coverage map<string,string>,
    claims array<map<string,string>>, telematics map<string,string>""",
    "umbrella": """policy_id string, policy_number string,
    insured_info map<string,string>, umbrella_coverage map<string,string>,
    underlying_policies array<map<string,string>>, claims array<map<string,string>>""",
    "general_liability": """policy_id string, policy_number string,
    insured struct<name: string, business_type: string, naics_code: string,
    address: string, city: string, state: string, zip: string>,
    coverage struct<occurrence_limit: string, aggregate_limit: string,
    deductible: string, premium: string>,
    claims array<struct<claim_id: string, date_of_occurrence: string,
    claim_type: string, amount: string, status: string>>""",
}


def payload_schema(name: str) -> T.StructType:
    return schema_of(PAYLOAD_DDL[name])


def flood_schema(kind: str) -> T.StructType:
    return all_strings({"claims": FLOOD_CLAIMS, "policies": FLOOD_POLICIES}[kind])


def flat_columns(line: Line) -> list[str]:
    policy = line.policies.columns.fieldNames()
    claim = [c for c in line.claims.columns.fieldNames() if c not in policy]
    return [*policy, *FLAT_EXTRA.get(line.code, []), *claim]


def flat_schema(line: Line) -> T.StructType:
    return all_strings(flat_columns(line))


def split_flat(flat: DataFrame, line: Line) -> dict[str, DataFrame]:
    """Bronze policy and claim frames out of a flat frame; rows without a claim have none."""
    audit = [c for c in flat.columns if c.startswith("_")]
    policies = select_available(flat, [*line.policies.columns.fieldNames(), *audit])
    claims = select_available(flat, [*line.claims.columns.fieldNames(), *audit])
    return {
        line.policies.sources[0]: policies,
        line.claims.sources[0]: claims.filter("claim_id IS NOT NULL"),
    }
