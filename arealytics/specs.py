"""Fixed values of the data formats, and the specs that drive the plans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame

# --------------------------------------------------------------------------
# Raw use report
# --------------------------------------------------------------------------

# raw column -> clean column
REPORT_COLUMNS = {
    "ADJUVANT": "adjuvant",
    "DATE": "date",
    "COMTRS": "comtrs",
    "POUNDS_CHEMICAL_APPLIED": "lbs_chm_used",
    "AERIAL_GROUND_INDICATOR": "aerial_ground",
    "AG_NONAG": "usetype",
    "AMOUNT_PLANTED": "amount_planted",
    "CHEMICAL_CODE": "chem_code",
    "COUNTY_CODE": "county_cd",
    "POUNDS_PRODUCT_APPLIED": "lbs_prd_used",
    "PRODUCT_CHEMICAL_PERCENT": "prodchem_pct",
    "PRODUCT_NUMBER": "prodno",
    "SITE_CODE": "site_code",
    "USE_NUMBER": "use_number",
}

# measures: text to number, and the texts that stand for "no value"
MEASURES = ["lbs_chm_used", "amount_planted", "lbs_prd_used", "prodchem_pct"]
MEASURE_BLANKS = ["nan", "MARCH", "ACRES"]

# codes: integers kept as text, and the texts that stand for "no value"
CODES = ["chem_code", "county_cd", "prodno", "site_code"]
CODE_BLANKS = ["GA"]

# measures that are apportioned by area, and those kept numeric in unit tables
APPORTIONED = ["lbs_prd_used", "lbs_chm_used"]
UNIT_NUMBERS = ["lbs_prd_used", "lbs_chm_used", "amount_planted"]

# month names as they appear in report dates; anything else is no month
MONTHS = {
    "JAN": "01",
    "FEB": "02",
    "MAR": "03",
    "APR": "04",
    "MAY": "05",
    "JUN": "06",
    "JUL": "07",
    "AUG": "08",
    "SEP": "09",
    "OCT": "10",
    "NOV": "11",
    "DEC": "12",
}

AG = "AG"
NONAG = "NONAG"

# --------------------------------------------------------------------------
# Label tables (id, label, flag columns); a row carries the label
# when any of the flag columns is exactly 'Y'
# --------------------------------------------------------------------------


class Label(NamedTuple):
    id: str
    label: str
    flags: tuple[str, ...]


RESTRICTED = "Restricted Material"

HEALTH = [
    Label("CARC", "Carcinogen", ("CARCINOGEN", "CARCINOGEN_ALL")),
    Label("GND", "Groundwater Contaminant", ("GND_WATER", "GND_WATER_ALL")),
    Label("REPR", "Reproductive Toxin", ("REPRODUCTIVE", "REPRODUCTIVE_ALL")),
    Label("TAC", "Toxic Air Contaminant", ("TAC", "TAC_ALL")),
    Label("CHI", "Cholinesterase Inhibitor", ("CARBAMATE", "CARB_ALL", "OP", "OP_ALL")),
    Label("RM", "Restricted Material", (RESTRICTED,)),
]

CLASSES = [
    Label("OP", "Organophosphate", ("OP", "OP_ALL")),
    Label("CARB", "Carbamate", ("CARBAMATE", "CARB_ALL")),
    Label("PYR", "Pyrethroid", ("PYRETHROID", "PYR_ALL")),
    Label("OCL", "Organochlorine", ("ORGANOCHLORINE", "ORGANOCHLORINE_ALL")),
    Label("NEO", "Neonicotinoid", ("NEONICOTINOID",)),
    Label("AM", "Amide", ("AMIDE",)),
    Label("AZ", "Azole", ("AZOLE",)),
    Label("BOT", "Botanical", ("BOTANICAL",)),
    Label("CP", "Chlorinated Phenol", ("CHLORINATED_PHENOL",)),
    Label("FA", "Fatty Acid", ("FATTY_ACID",)),
    Label("GLY", "Glycol", ("GLYCOL",)),
    Label("HO", "Halogenated Organic", ("HALOGENATED_ORGANIC",)),
    Label("INO", "Inorganic", ("INORGANIC",)),
    Label("MIC", "Microbial", ("MICROBIAL",)),
    Label("PH", "Phenol", ("PHENOL",)),
    Label("PX", "Phenoxy", ("PHENOXY",)),
    Label("PR", "Pheromone", ("PHEROMONE",)),
    Label("SOAP", "Soap", ("SOAP",)),
    Label("ST", "Strobilurin", ("STROBILURIN",)),
    Label("SU", "Sulfonylurea", ("SULFONYLUREA",)),
    Label("TR", "Triazine", ("TRIAZINE",)),
    Label("UR", "Urea", ("UREA",)),
    Label("FUM", "Fumigant", ("FUMIGANT", "FUMIGANT_ALL")),
    Label("OIL", "Oil", ("OIL", "OIL_ALL")),
    Label("BIO", "Biopesticide", ("BIOPESTICIDE", "BIOPESTICIDE_ALL")),
    Label("IGR", "Insect Growth Regulator", ("INSECT_GROWTH_REGULATOR", "IGR_ALL")),
]

# every flag column the label tables look at, in order of first mention
FLAGS = list(
    dict.fromkeys(
        flag for label in HEALTH + CLASSES for flag in label.flags if flag != RESTRICTED
    )
)

# type of ingredient that gets no type code
EXCLUDED_TYPE = "ADJUVANT"

# --------------------------------------------------------------------------
# demography
# --------------------------------------------------------------------------

POPULATION = "Total Population"
INCOME = "Median Household Income (In 2021 Inflation Adjusted Dollars)"
HISPANIC = "Total Population: Hispanic or Latino"
BLACK = "Total Population: Not Hispanic or Latino: Black or African American Alone"
WHITE = "Total Population: Not Hispanic or Latino: White Alone"
ASIAN = "Total Population: Not Hispanic or Latino: Asian Alone"
AIAN = "Total Population: Not Hispanic or Latino: American Indian and Alaska Native Alone"
NHPI = "Total Population: Not Hispanic or Latino: Native Hawaiian and Other Pacific Islander Alone"
OVER_25 = "Population 25 Years and Over:"
NO_HIGH_SCHOOL = "Population 25 Years and Over: Less than High School"
EMPLOYED = "Total Employed Civilian Population 16 Years and Over"
FARMING = "Employed Civilian Population 16 Years and Over: Agriculture, Forestry, Fishing and Hunting, and Mining"

# counts that are shared out by area; income is averaged instead
COUNTS = [
    POPULATION,
    HISPANIC,
    BLACK,
    WHITE,
    ASIAN,
    AIAN,
    NHPI,
    NO_HIGH_SCHOOL,
    OVER_25,
    FARMING,
    EMPLOYED,
]

# short names used by the county and school district tables
SHORT_NAMES = {
    "NH Black or African American Alone": BLACK,
    "Hispanic or Latino": HISPANIC,
    "Population 25 and Over": OVER_25,
    "Population 25 and Over: Less than High School": NO_HIGH_SCHOOL,
    "Employed: Agriculture, Forestry, Fishing and Hunting, and Mining": FARMING,
    "Employed 16 and Over": EMPLOYED,
    "NH White Alone": WHITE,
    "NH Asian Alone": ASIAN,
    "NH American Indian and Alaska Native Alone": AIAN,
    "NH Native Hawaiian and Other Pacific Islander Alone": NHPI,
}

# (output suffix, source column) for the groups with a count and a share
GROUPS = [
    ("NH Black", BLACK),
    ("Hispanic", HISPANIC),
    ("NH White", WHITE),
    ("NH Asian", ASIAN),
    ("NH AIAN", AIAN),
    ("NH NHPI", NHPI),
]

# older form: (output column, source column)
OLDER_SHARES = [
    ("pct_black", BLACK),
    ("pct_hispanic", HISPANIC),
    ("pct_nh_white", WHITE),
    ("pct_nh_asian", ASIAN),
    ("pct_american_indian", AIAN),
    ("pct_native_hawaiian_pacific_islander", NHPI),
]
OLDER_COUNTS = [POPULATION, HISPANIC, BLACK, WHITE, ASIAN, AIAN, NHPI]

# the seven totals compared between levels: (key, column)
POPULATION_TOTALS = [
    ("total", "Pop Total"),
    ("nh_black", "Pop NH Black"),
    ("hispanic", "Pop Hispanic"),
    ("nh_white", "Pop NH White"),
    ("nh_asian", "Pop NH Asian"),
    ("nh_aian", "Pop NH AIAN"),
    ("nh_nhpi", "Pop NH NHPI"),
]

# state prefix of county codes, and the code of "no district"
STATE_PREFIX = "06"
NO_DISTRICT = "0699999"

# overlap above which a source counts as lying in one target only
DOMINANT_SHARE = 0.95

# --------------------------------------------------------------------------
# Specs
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class UnitSpec:
    """How one geographic level's fact table is derived."""

    name: str
    area_id: str
    drop: tuple[str, ...] = ()
    usetypes: tuple[str, ...] | None = None  # None: no filter
    ratio: str = "AREA_RATIO"


_SECTION_ONLY = ("comtrs", "MeridianTownshipRange", "prodchem_pct")

TRACT = UnitSpec("tract", "GEOID", _SECTION_ONLY, (AG,))
SCHOOL = UnitSpec("school", "FIPS", _SECTION_ONLY, (AG,))
ZIP = UnitSpec("zip", "ZCTA5CE20", _SECTION_ONLY, (AG,))
COUNTY = UnitSpec("county", "FIPS", ("MeridianTownshipRange", "comtrs"))
TOWNSHIP = UnitSpec("township", "MeridianTownshipRange", ("comtrs",))
SECTION = UnitSpec("section", "comtrs")


@dataclass(frozen=True)
class DimensionSpec:
    """A code table, the fact column it describes and its output columns."""

    name: str
    fact_id: str
    file_id: str
    label: str
    columns: tuple[str, ...] = ()  # empty: all
    rename: tuple[tuple[str, str], ...] = ()

    @property
    def out_id(self) -> str:
        return dict(self.rename).get(self.file_id, self.file_id)

    @property
    def out_label(self) -> str:
        return dict(self.rename).get(self.label, self.label)


CHEMICALS = DimensionSpec(
    "chemicals",
    "chem_code",
    "chem_code",
    "chemname",
    ("chem_code", "chemname"),
    (("chemname", "chem_name"),),
)
SITES = DimensionSpec("sites", "site_code", "site_code", "site_name")
PRODUCTS = DimensionSpec(
    "products",
    "prodno",
    "prodno",
    "product_name",
    ("prodno", "product_name"),
    (("prodno", "product_code"),),
)

# a user's own derived column: takes the frame, gives the column
Derive = Callable[[DataFrame], Column]
