"""Census data model: column names, the declared schema and fixed lookup values.

A census row is a pre-aggregated group of schools: ``Total_Number_of_Schools``
is the group size (the weight) and every facility column holds the number of
schools in the group that have the facility.
"""

from __future__ import annotations

from pyspark.sql import types as T

STATE = "State_Name"
DISTRICT = "District_Name"
LOCATION = "Location"
MGMT_NAME = "School_Management_Name"
MGMT_ID = "School_Management_Id"
PERIOD = "Academic_Year"
TOTAL = "Total_Number_of_Schools"

RURAL = "Rural"
URBAN = "Urban"

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the study's definitions).
# ---------------------------------------------------------------------------

# Facility measure columns of the census, in schema order.
MEASURES = [
    "Functional_Electricity",
    "Solar_Panel",
    "Playground",
    "Library_or_Reading_Corner_or_Book_Bank",
    "Newspaper",
    "Kitchen_Garden",
    "Functional_Boy_Toilet",
    "Functional_Girl_Toilet",
    "Functional_Toilet_Facility",
    "Functional_Toilet_and_Urinal",
    "Functional_Drinking_Water",
    "Water_Purifier",
    "Rain_Water_Harvesting",
    "Handwash",
    "Incinerator",
    "Water_Tested",
    "WASH_Facility_Drinking_Water_Toilet_and_Handwash",
    "Ramps",
    "Medical_Checkup",
    "Complete_Medical_Checkup",
    "Internet",
    "Computer_Available",
    "Functional_Urinal_Boy",
    "Functional_Urinal_Girl",
    "Functional_Urinal",
]

# Essential facilities (output name -> census column); Newspaper is reported
# as Functional_Newspaper.
ESSENTIALS = {
    "Functional_Drinking_Water": "Functional_Drinking_Water",
    "Functional_Boy_Toilet": "Functional_Boy_Toilet",
    "Functional_Girl_Toilet": "Functional_Girl_Toilet",
    "Handwash": "Handwash",
    "Functional_Electricity": "Functional_Electricity",
    "Functional_Newspaper": "Newspaper",
    "Library_or_Reading_Corner_or_Book_Bank": "Library_or_Reading_Corner_or_Book_Bank",
    "Playground": "Playground",
}
ADVANCED = {"Internet": "Internet", "Computer_Available": "Computer_Available"}
# Per-district feature set of the correlation study: essentials, advanced, ramps.
DISTRICT_FEATURES = {**ESSENTIALS, **ADVANCED, "Ramps": "Ramps"}

# Self-sustainability: each facility is divided by the total, then weighted.
SUSTAINABILITY_WEIGHTS = [
    ("Solar_Panel", 0.2),
    ("Kitchen_Garden", 0.3),
    ("Rain_Water_Harvesting", 0.4),
    ("Incinerator", 0.1),
]
# Hygiene: weighted sum of facilities, times 100, divided by the total.
HYGIENE_WEIGHTS = [
    ("Functional_Drinking_Water", 0.25),
    ("Water_Purifier", 0.25),
    ("Functional_Toilet_Facility", 0.25),
    ("Handwash", 0.15),
    ("Functional_Urinal", 0.05),
    ("Water_Tested", 0.05),
]

# School management ids grouped into sectors.
SECTORS = {
    "Private": [5],
    "Aided": [4],
    "Others": [3, 97, 98],
    "Government": [1, 2, 6, 8, 90, 91, 92, 93, 94, 95, 96, 101],
}
PRIVATE_UNAIDED_ID = 5

# School management names by id.
MANAGEMENT_NAMES = {
    1: "Department of Education",
    2: "Tribal Welfare Department",
    3: "Unrecognised",
    4: "Government Aided",
    5: "Private Unaided (Recognized)",
    6: "Other Govt. managed schools",
    8: "Local body",
    90: "Social welfare Department",
    91: "Ministry of Labour",
    92: "Kendriya Vidyalaya",
    93: "Jawahar Navodaya Vidyalaya",
    94: "Sainik School",
    95: "Railway School",
    96: "Central Tibetan School",
    97: "Madarsa recognized (by Wakf board/Madarsa Board)",
    98: "Madarsa unrecognized",
    101: "Other Central Govt. Schools",
}

# State spelling fixes applied before aggregation.
STATE_ALIASES = [("Kerla", "Kerala")]

# ---------------------------------------------------------------------------

CENSUS_SCHEMA = T.StructType(
    [
        T.StructField(STATE, T.StringType()),
        T.StructField(DISTRICT, T.StringType()),
        T.StructField(LOCATION, T.StringType()),
        T.StructField(MGMT_NAME, T.StringType()),
        T.StructField(MGMT_ID, T.IntegerType()),
        T.StructField(PERIOD, T.StringType()),
        T.StructField(TOTAL, T.IntegerType()),
    ]
    + [T.StructField(m, T.IntegerType()) for m in MEASURES]
)

CENSUS_COLUMNS = [f.name for f in CENSUS_SCHEMA.fields]
