"""Fixed values of the data domain; they must stay as they are for equal results."""

from __future__ import annotations

# Codes.
DEPARTMENT = "75"
COMMUNE = "75056"
AREA_PREFIX = "751"
AREA_CODES = [f"{AREA_PREFIX}{n:02d}" for n in range(1, 21)]

# Inhabitants of areas 1 to 20.
POPULATION = [
    16_888, 20_796, 35_011, 27_487, 58_283, 40_580, 49_988, 35_879,
    58_730, 89_603, 144_492, 138_188, 178_544, 137_105, 233_392,
    166_851, 167_835, 197_309, 184_787, 193_098,
]

# Dwellings of areas 1 to 20.
DWELLINGS = [
    10_500, 14_300, 23_000, 19_400, 35_000, 28_000, 31_500, 25_700,
    42_000, 60_500, 91_000, 80_700, 105_000, 84_500, 142_500,
    108_000, 109_500, 121_300, 110_000, 117_400,
]

# Approximate centre (lon, lat) of areas 1 to 20.
AREA_CENTRES = [
    (2.337, 48.862), (2.347, 48.868), (2.362, 48.863), (2.357, 48.854),
    (2.350, 48.844), (2.333, 48.849), (2.312, 48.856), (2.318, 48.872),
    (2.337, 48.877), (2.361, 48.876), (2.380, 48.859), (2.421, 48.835),
    (2.362, 48.829), (2.327, 48.829), (2.300, 48.840), (2.262, 48.860),
    (2.307, 48.887), (2.349, 48.892), (2.385, 48.887), (2.401, 48.863),
]

# Half width and half height in degrees of the stand-in boxes.
AREA_BOX = (0.012, 0.008)
FEATURE_BOX = (0.014, 0.009)

# Bounds of the validation rules.
LON_RANGE = (2.20, 2.50)
LAT_RANGE = (48.80, 48.92)
VALUE_RANGE = (50_000.0, 50_000_000.0)
MIN_SURFACE = 9.0
DWELLING_TYPES = ["Appartement", "Maison"]
UNIT_PRICE_RANGE = (1000.0, 40000.0)

# Tokens that mean null in each landed CSV.
TRANSACTION_NULLS = ["", "NA"]
INCOME_NULLS = ["", "ND", "NA"]
POI_NULLS = ["", "NA", "ND"]

# Income row used when the commune is missing.
INCOME_FALLBACK = {"code_commune": COMMUNE, "MED21": 29110.0, "PIMP21": 80.6,
                   "TP6021": 16.1, "RD21": 4.7}

# Air measures used when none were landed.
AIR_FALLBACK = [
    ("2024-01-15T12:00:00Z", 38.2, 22.1, 19.4, 11.8),
    ("2024-04-15T12:00:00Z", 31.5, 48.0, 17.2, 9.1),
    ("2024-07-15T12:00:00Z", 24.7, 65.3, 21.0, 12.4),
    ("2024-10-15T12:00:00Z", 35.9, 28.7, 18.5, 10.2),
]
POLLUTANTS = ["no2", "o3", "pm10", "pm25"]

# Point-of-interest sources, key to (category, subcategory).
CITY_POI = {
    "velib_stations": ("transport", "velib"),
    "belib_bornes": ("transport", "borne_electrique"),
    "amenagements_cyclables": ("transport", "piste_cyclable"),
    "ecoles_elementaires": ("service_public", "ecole"),
    "colleges": ("service_public", "college"),
    "marches": ("commerce", "marche"),
    "que_faire_paris": ("culture", "evenement"),
    "espaces_verts": ("environnement", "espace_vert"),
    "sanisettes": ("service_public", "sanisette"),
}
NATIONAL_POI = {
    "musees_france": ("culture", "musee"),
    "hopitaux_idf": ("sante", "hopital"),
    "monuments_historiques": ("culture", "monument"),
}
# Optional row filter of a national source, key to (column, value).
NATIONAL_POI_FILTER = {"musees_france": ("REGION", "11")}

CATEGORIES = ["transport", "service_public", "commerce", "culture", "sante", "environnement"]

# Column aliases of the landed points of interest, in order of preference.
COORDINATE_ALIASES = [("longitude", "latitude"), ("lon", "lat"), ("x_long", "y_lat"), ("x", "y")]
NAME_ALIASES = ["name", "nom", "libelle", "title", "stationname"]

INDICATORS = ["idx_accessibilite", "idx_tension", "idx_effort_social", "idx_attractivite"]
SORT_KEYS = ["code_arrondissement", "prix_m2", "idx_attractivite", "idx_accessibilite",
             "idx_tension"]
COMPARED = ["prix_m2", *INDICATORS]

PAGE_SIZE = 50
