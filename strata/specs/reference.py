"""Fixed reference rows.

Fixed values: all tables in this module must hold exactly these texts, because stored keys
and reports are derived from them.
"""

# lob_code, lob_name, lob_category, regulatory_body, naic_code
LINES_OF_BUSINESS = [
    ("PROP", "Property", "Property", "State DOI", "04.0"),
    ("WC", "Workers Compensation", "Casualty", "NCCI / State WC Board", "16.0"),
    ("AUTO", "Auto", "Casualty", "State DOI", "19.4"),
    ("GL", "General Liability", "Casualty", "ISO / State DOI", "17.0"),
    ("UMB", "Umbrella", "Casualty", "ISO / State DOI", "17.3"),
]
# Optional sixth line.
PROFESSIONAL_LINE = ("PL", "Professional Liability", "Specialty", "State DOI", "11.0")

# lob_code, coverage_id, coverage_code, coverage_name, coverage_type, description, mandatory
COVERAGES = [
    ("PROP", "COV-PROP-BLDG", "BLDG", "Building Coverage", "Property",
     "Covers the physical structure", True),
    ("PROP", "COV-PROP-CONT", "CONT", "Contents Coverage", "Property",
     "Covers personal property/contents", False),
    ("PROP", "COV-PROP-LOU", "LOU", "Loss of Use", "Property",
     "Covers additional living expenses", False),
    ("PROP", "COV-PROP-ICC", "ICC", "Increased Cost of Compliance", "Property",
     "Covers floodplain compliance costs", False),
    ("WC", "COV-WC-MED", "WC-MED", "Medical Benefits", "Workers Comp",
     "Medical treatment for work injuries", True),
    ("WC", "COV-WC-IND", "WC-IND", "Indemnity Benefits", "Workers Comp",
     "Wage replacement benefits", True),
    ("WC", "COV-WC-EL", "WC-EL", "Employers Liability", "Workers Comp",
     "Employers liability coverage", True),
    ("AUTO", "COV-AUTO-BI", "AUTO-BI", "Bodily Injury Liability", "Auto",
     "Covers injuries to others", True),
    ("AUTO", "COV-AUTO-PD", "AUTO-PD", "Property Damage Liability", "Auto",
     "Covers damage to others property", True),
    ("AUTO", "COV-AUTO-COMP", "AUTO-COMP", "Comprehensive", "Auto",
     "Non-collision damage coverage", False),
    ("AUTO", "COV-AUTO-COLL", "AUTO-COLL", "Collision", "Auto",
     "Collision damage coverage", False),
    ("AUTO", "COV-AUTO-UM", "AUTO-UM", "Uninsured Motorist", "Auto",
     "Protection from uninsured drivers", False),
    ("GL", "COV-GL-PREM", "GL-PREM", "Premises Liability", "General Liability",
     "Covers on-premises injuries", True),
    ("GL", "COV-GL-PROD", "GL-PROD", "Products Liability", "General Liability",
     "Covers product-related injuries", False),
    ("GL", "COV-GL-COMP", "GL-COMP", "Completed Operations", "General Liability",
     "Covers post-completion claims", False),
    ("GL", "COV-GL-PI", "GL-PI", "Personal Injury", "General Liability",
     "Covers non-physical injuries", False),
    ("UMB", "COV-UMB-EXCESS", "UMB-EXCESS", "Excess Liability", "Umbrella",
     "Excess coverage above underlying", True),
    ("UMB", "COV-UMB-DROP", "UMB-DROP", "Drop Down Coverage", "Umbrella",
     "Coverage when underlying exhausted", False),
]

# profession_type, profession_category, requires_board_cert, avg_claim_severity
PROFESSIONS = [
    ("Doctor", "Medical", True, "Very High"),
    ("Surgeon", "Medical", True, "Very High"),
    ("Dentist", "Medical", True, "High"),
    ("Lawyer", "Legal", False, "High"),
    ("Accountant (CPA)", "Financial", True, "Medium"),
    ("Financial Advisor", "Financial", False, "Medium"),
    ("IT Consultant", "Technology", False, "Low"),
    ("Architect", "Engineering", True, "Medium"),
    ("Real Estate Agent", "Financial", False, "Low"),
]

# Postal code and name of each state.
US_STATES = [
    ("AL", "Alabama"), ("AK", "Alaska"), ("AZ", "Arizona"), ("AR", "Arkansas"),
    ("CA", "California"), ("CO", "Colorado"), ("CT", "Connecticut"), ("DE", "Delaware"),
    ("FL", "Florida"), ("GA", "Georgia"), ("HI", "Hawaii"), ("ID", "Idaho"),
    ("IL", "Illinois"), ("IN", "Indiana"), ("IA", "Iowa"), ("KS", "Kansas"),
    ("KY", "Kentucky"), ("LA", "Louisiana"), ("ME", "Maine"), ("MD", "Maryland"),
    ("MA", "Massachusetts"), ("MI", "Michigan"), ("MN", "Minnesota"), ("MS", "Mississippi"),
    ("MO", "Missouri"), ("MT", "Montana"), ("NE", "Nebraska"), ("NV", "Nevada"),
    ("NH", "New Hampshire"), ("NJ", "New Jersey"), ("NM", "New Mexico"), ("NY", "New York"),
    ("NC", "North Carolina"), ("ND", "North Dakota"), ("OH", "Ohio"), ("OK", "Oklahoma"),
    ("OR", "Oregon"), ("PA", "Pennsylvania"), ("RI", "Rhode Island"),
    ("SC", "South Carolina"), ("SD", "South Dakota"), ("TN", "Tennessee"), ("TX", "Texas"),
    ("UT", "Utah"), ("VT", "Vermont"), ("VA", "Virginia"), ("WA", "Washington"),
    ("WV", "West Virginia"), ("WI", "Wisconsin"), ("WY", "Wyoming"),
    ("DC", "District of Columbia"),
]

RISK_TIERS = ["Preferred", "Standard", "Substandard"]
COMMISSION_TIERS = ["Standard", "Preferred", "Elite"]

CEDED_RATE = "0.15"
COMMISSION_RATE = "0.12"
TAX_RATE = "0.03"
LEGAL_EXPENSE_RATE = "0.15"
