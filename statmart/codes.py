"""Code lists, labels and rule words the marts are defined by.

Everything here is a default.  Functions take the list they need as a
parameter, so another publisher's codes can be passed instead.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Population status codes and their display labels.
STATUS_LABELS = {
    "canadian_born": "Canadian-born Citizens",
    "naturalized": "Naturalized Citizens",
    "permanent_resident": "Permanent Residents",
    "non_permanent_resident": "Temporary Residents",
}
RESIDENT_STATUSES = ("canadian_born", "naturalized", "permanent_resident")
TEMPORARY_STATUS = "non_permanent_resident"

# Short status labels used by the census trend view.
STATUS_TREND_LABELS = {
    "canadian_born": "Canadian-born",
    "naturalized": "Naturalized Citizen",
    "permanent_resident": "Permanent Resident",
    "non_permanent_resident": "Non-Permanent Resident",
}

# Place-name aliases and the aggregate rows found among places.
PLACE_ALIASES = {
    "China, People's Republic of": "China",
    "Korea, Republic of": "South Korea",
    "United States of America": "United States",
    "United Kingdom and Overseas Territories": "United Kingdom",
    "United Kingdom of Great Britain and Northern Ireland": "United Kingdom",
    "Viet Nam": "Vietnam",
    "Korea, South": "South Korea",
    "Cameroon, Federal Republic of": "Cameroon",
}
PLACE_AGGREGATES = (
    "Total",
    "Other Countries",
    "Southeast Asia",
    "West Central Asia and the Middle East",
    "Caribbean and Bermuda",
    "Sub-Saharan Africa",
    "Northern and Western Africa",
    "Central America",
    "South America",
    "Eastern Europe",
    "Western Europe",
    "Northern Europe",
    "Southern Europe",
    "Central Asia",
    "Eastern Africa",
    "Western Africa",
    "North America",
    "Central Africa",
)
NON_PLACES = ("unknown", "other", "all countries", "_")
NON_PLACE_PREFIX = "other"

# Replacements that shorten place names for chart legends.
PLACE_SHORT_FORMS = (
    ("China, People's Republic of", "China"),
    ("United States of America", "USA"),
    ("United Kingdom of Great Britain and Northern Ireland", "UK"),
)


@dataclass(frozen=True)
class PlaceRules:
    """How place names are merged and which of them are not places at all."""

    aliases: tuple[tuple[str, str], ...] = tuple(PLACE_ALIASES.items())
    aggregates: tuple[str, ...] = PLACE_AGGREGATES
    non_places: tuple[str, ...] = NON_PLACES
    non_place_prefix: str = NON_PLACE_PREFIX


DEFAULT_PLACES = PlaceRules()


@dataclass(frozen=True)
class RegionRules:
    """A lower-cased name is a region if it contains or equals a listed text."""

    contains: tuple[str, ...]
    exact: tuple[str, ...]


# Region words as published rows were filtered with them.  They
# let "Asia" through and drop South Africa; kept for comparison runs.
COMPATIBLE_REGIONS = RegionRules(
    contains=(
        "outside canada", "africa", " asia", "asia ", "southeast asia",
        "south asia", "west central asia", "east asia", "south-east",
        "eastern asia", "southern asia", "western asia", "central asia",
        "americas", "europe", "oceania", "caribbean", "bermuda",
        "melanesia", "micronesia", "polynesia", "not stated", "total",
        "northern africa", "western africa", "eastern africa", "southern africa",
        "middle africa", "northern america", "central america", "south america",
    ),
    exact=(
        "inside canada",
        "north america",
        "other",
        "ontario",
        "quebec",
        "british columbia",
        "alberta",
        "saskatchewan",
        "manitoba",
        "nova scotia",
        "new brunswick",
        "newfoundland and labrador",
        "prince edward island",
    ),
)

# Whole-name matching: only wordings that never occur inside a country name are
# searched for, every region and province has to match completely.
CORRECTED_REGIONS = RegionRules(
    contains=("outside canada", "not stated", "total"),
    exact=(
        "africa", "northern africa", "western africa", "eastern africa",
        "southern africa", "middle africa", "central africa", "sub-saharan africa",
        "northern and western africa",
        "asia", "east asia", "eastern asia", "south asia", "southern asia",
        "southeast asia", "south-east asia", "south-eastern asia", "western asia",
        "central asia", "west central asia", "west central asia and the middle east",
        "middle east",
        "america", "americas", "north america", "northern america",
        "central america", "south america", "caribbean", "bermuda",
        "caribbean and bermuda",
        "europe", "eastern europe", "western europe", "northern europe",
        "southern europe",
        "oceania", "oceania and other", "melanesia", "micronesia", "polynesia",
        "inside canada", "other",
        "ontario", "quebec", "british columbia", "alberta", "saskatchewan",
        "manitoba", "nova scotia", "new brunswick", "newfoundland and labrador",
        "prince edward island",
    ),
)

# ---------------------------------------------------------------------------
# Non-permanent-resident types in the source and their codes.
NPR_TYPE_CODES = {
    "Asylum claimants, protected persons and related groups with work permit only": "asylum_work_permit_only",
    "Asylum claimants, protected persons and related groups with study permit only": "asylum_study_permit_only",
    "Asylum claimants, protected persons and related groups with work and study permits": "asylum_work_and_study",
    "Asylum claimants, protected persons and related groups without work or study permits": "asylum_no_permit",
    "Work permit holders only": "permit_work_only",
    "Study permit holders only": "permit_study_only",
    "Work and study permit holders": "permit_work_and_study",
    "Other": "permit_other",
}

# Labels of the streams on the overview chart and their groups.
STREAM_LABELS = {
    "permit_work_only": "Work Permit (only)",
    "permit_study_only": "Study Permit (only)",
    "permit_work_and_study": "Work & Study Permit",
    "permit_other": "Other Permit Holders",
    "asylum_work_permit_only": "Asylum — Work Permit",
    "asylum_study_permit_only": "Asylum — Study Permit",
    "asylum_work_and_study": "Asylum — Work & Study Permit",
    "asylum_no_permit": "Asylum — No Permit",
}
ASYLUM_STREAMS = (
    "asylum_no_permit",
    "asylum_work_permit_only",
    "asylum_study_permit_only",
    "asylum_work_and_study",
)
ASYLUM_LABEL = "Asylum Claimants"
STREAM_PANELS = {
    "Asylum Claimants": ASYLUM_STREAMS,
    "Work Permit Holders": ("permit_work_only", "permit_work_and_study"),
    "Other Permit Holders": ("permit_other",),
}

# Series of the blended history, with label and group.
SERIES_META = {
    "permit_work_only": ("Work Permit Only", "Quarterly"),
    "permit_study_only": ("Study Permit Only", "Quarterly"),
    "permit_work_and_study": ("Work and Study Permit", "Quarterly"),
    "permit_other": ("Other Permit Holders", "Quarterly"),
    "asylum_work_permit_only": ("Asylum: Work Permit Only", "Quarterly"),
    "asylum_study_permit_only": ("Asylum: Study Permit Only", "Quarterly"),
    "asylum_work_and_study": ("Asylum: Work and Study Permit", "Quarterly"),
    "asylum_no_permit": ("Asylum: No Permit", "Quarterly"),
    "annual_study_permit_holders": ("Study Permit Holders (Annual Fallback)", "Annual fallback"),
    "annual_work_permit_holders": ("Work Permit Holders (Annual Fallback)", "Annual fallback"),
    "annual_asylum_claimants": ("Asylum Claimants (Annual Fallback)", "Annual fallback"),
}
ANNUAL_SERIES = {
    "study": "annual_study_permit_holders",
    "work": "annual_work_permit_holders",
    "asylum": "annual_asylum_claimants",
}

# ---------------------------------------------------------------------------
# Work-permit program codes, labels, and classification words in
# the order they are tried.
PROGRAM_LABELS = {
    "tfwp": "Temporary Foreign Worker Program",
    "imp": "International Mobility Program",
    "other": "Other / Unmapped",
}
PROGRAM_COLUMNS = (
    "EN_PROGRAM",
    "EN_PROGRAM_TYPE",
    "EN_PROGRAM_STREAM",
    "EN_PROGRAM_CATEGORY",
    "EN_CATEGORY",
    "EN_STREAM",
)
# (words that may occur anywhere, texts that must match completely, code)
PROGRAM_RULES = (
    (("temporary foreign worker", "tfwp"), (), "tfwp"),
    (("international mobility", "imp "), ("imp",), "imp"),
    (("seasonal agricultural worker",), (), "tfwp"),
    (("post-graduation", "open work permit"), (), "imp"),
)
DEFAULT_PROGRAM = "other"

# Origin categories, in publication order.
ORIGIN_CATEGORIES = {
    "foreign_born_total": "Foreign-born Total",
    "naturalized": "Naturalized Citizens",
    "permanent_resident": "Permanent Residents",
    "temporary_resident": "Temporary Residents",
}

# What follows "Non-top-<k> " in the foreign-born list.
REMAINDER_LABELS = {
    "naturalized": "Naturalized",
    "permanent_resident": "Permanent Residents",
    "temporary_resident": "Temporary Residents",
}

# ---------------------------------------------------------------------------
# Texts that stand for a suppressed or missing number.
NULL_TOKENS = ("--", "- -", "N/A", "n/a")

# Month names as they occur in the extracts.
MONTH_NUMBERS = {
    "jan": 1, "january": 1,
    "feb": 2, "february": 2,
    "mar": 3, "march": 3,
    "apr": 4, "april": 4,
    "may": 5,
    "jun": 6, "june": 6,
    "jul": 7, "july": 7,
    "aug": 8, "august": 8,
    "sep": 9, "sept": 9, "september": 9,
    "oct": 10, "october": 10,
    "nov": 11, "november": 11,
    "dec": 12, "december": 12,
}

# Census extract column names and the member names read from it.
CENSUS_CITIZENSHIP = "Citizenship (9)"
CENSUS_AGE = "Age (8D)"
CENSUS_GENDER = "Gender (3)"
CENSUS_STATISTIC = "Statistics (3)"
CENSUS_BIRTHPLACE = "Place of birth (290)"
CENSUS_STATUS_PREFIX = "Immigrant status"
CENSUS_STATUS_TAGS = {"total": "[1]", "immigrant": "[3]", "non_permanent": "[11]"}
CENSUS_MEMBERS = {
    CENSUS_STATISTIC: "Count",
    CENSUS_AGE: "Total - Age",
    CENSUS_GENDER: "Total - Gender",
}
CITIZEN_BY_BIRTH = "Canadian citizens by birth"
CITIZEN_NATURALIZED = "Canadian citizens by naturalization"
NOT_CITIZEN = "Not Canadian citizens"

# Default geography, null dimension and whole-year month.
FOCUS_GEO = "Canada"
NO_DIMENSION = "_"
WHOLE_YEAR = 0
DEFAULT_CENSUS_YEAR = 2021
NO_PERIOD = "Latest available"
