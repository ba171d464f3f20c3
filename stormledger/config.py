"""Fixed values of the data contract. They must not be tuned."""

# --- fixed values -----------------------------------------------------------

EPOCH = "2017-01-01"  # start offsets are whole seconds from here
FIRST_YEAR = 2017
LAST_YEAR = 2026
TIME_ZONE = "America/Sao_Paulo"  # zone of the wall time in the fact
CLIMATE_UF = "MG"

# Grid: 0.25 degree points, box given as north, west, south, east.
GRID_STEP = 0.25
GRID_BOX = (-14.0, -51.25, -23.0, -39.75)
MIN_CELL_SHARE = 1e-4

# Rain and gust are stored as hundredths in 16 bits, clipped first.
CLIMATE_SCALE = 100
CLIMATE_CLIP = 320

# Causes that depend on the weather.
WEATHER_DETAILS = (
    "VENTO",
    "DESCARGA ATMOSFERICA",
    "ARVORE OU VEGETACAO",
    "INUNDACAO",
    "EROSAO",
    "QUEIMA OU INCENDIO",
)

# Spellings that mean the same category.
SYNONYMS = {
    "INTERNO": "INTERNA",
    "EXTERNO": "EXTERNA",
    "NAO PROGAMADA": "NAO PROGRAMADA",
    "N??O PROGRAMADA": "NAO PROGRAMADA",
    "QUEIMADA OU INCENDIO": "QUEIMA OU INCENDIO",
    "MARESIA OU CORROSAO": "CORROSAO",
}

CAUSE_SEPARATORS = r"\s*[-;/]\s*"
UNKNOWN_CAUSE = "NAO INFORMADA"

# Bands are (label, lower edge); a band runs to the next lower edge.
# Rain keeps exact zero as a band of its own.
RAIN_BANDS = (
    ("sem chuva", 0.0),
    ("até 0,5 mm", 0.0),
    ("0,5–1 mm", 0.5),
    ("1–2 mm", 1.0),
    ("2–5 mm", 2.0),
    ("5 mm ou mais", 5.0),
)
GUST_BANDS = (
    ("até 20 km/h", float("-inf")),
    ("20–30", 20.0),
    ("30–40", 30.0),
    ("40–50", 40.0),
    ("50–60", 50.0),
    ("60 km/h ou mais", 60.0),
)

STORM_MM = 5  # an hour at or above this is heavy rain
STORM_WINDOW_H = 48  # hours looked at on each side of a storm onset
STORM_QUIET_H = 6  # hours without heavy rain that make it an onset

# Duration bands in minutes: 15-minute steps below 720, then these floors.
DURATION_STEP = 15
DURATION_TAIL = (720, 1440, 4320)

# Rules of the audit: (name here, label, tolerated rows); None only warns.
FACT_RULES = (
    ("no_zone", "conjunto nulo", 0),
    ("no_start", "início nulo", 0),
    ("start_outside", "início fora de {}–{}", 0),
    ("negative_customers", "consumidores afetados negativo", 0),
    ("negative_duration", "duração negativa (fim antes do início)", 1),
    ("more_than_all", "afetados maior que o conjunto inteiro", 5_055),
    ("other_year", "ano de competência diferente do ano de início", None),
    ("no_duration", "duração zero", None),
    ("no_customers", "nenhum consumidor afetado", None),
    ("no_detail", "sem detalhe de causa", None),
    ("no_cause", "sem causa", None),
    ("unknown_voltage", "nível de tensão 9999 (sentinela de desconhecido)", None),
    ("over_three_days", "duração acima de três dias", None),
)
CLIMATE_RULES = (
    ("missing", "chuva ou rajada nula", 0),
    ("negative_rain", "chuva negativa", 0),
    ("no_gust", "rajada não positiva", 0),
    ("rain_over", "chuva acima de 100 mm/h", 0),
    ("gust_over", "rajada acima de 150 km/h", 0),
)
REFERENCE_RULES = (
    ("fact_zone", "conjunto do fato fora da ponte", None),
    ("bridge_city", "município da ponte fora da dimensão", 0),
    ("bridge_shape", "conjunto da ponte sem geometria", 0),
)

MEASURES = ("interrupcoes", "consumidores")
TOP_CATEGORIES = 7
OTHER_CATEGORY = "Outras"

MAX_PROVISIONAL_DAYS = 61  # younger climate months are fetched again
CLIMATE_LATENCY_DAYS = 6
REPORTING_GRAIN_MIN_ROWS = 100_000
