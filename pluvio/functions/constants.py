"""Fixed values that results depend on.

These must stay exactly as written: they are the labels, prefixes and
lookup entries the published tables carry.
"""

# --- fixed values ---------------------------------------------------------

# Prefix of station ids in the daily-summaries dataset; the row key drops it.
STATION_PREFIX = "GHCND:"

# The four measurements pivoted into columns (°C for temperatures, mm for rain).
DATATYPES = ("TMAX", "TMIN", "TAVG", "PRCP")

# Southern-hemisphere seasons by calendar month, in presentation order.
SEASONS = (
    ("Verão", (12, 1, 2)),
    ("Outono", (3, 4, 5)),
    ("Inverno", (6, 7, 8)),
    ("Primavera", (9, 10, 11)),
)
SEASON_FALLBACK_RANK = 99

# Brazilian state name -> two-letter code (27 entries).
STATE_CODES = (
    ("Acre", "AC"),
    ("Alagoas", "AL"),
    ("Amapá", "AP"),
    ("Amazonas", "AM"),
    ("Bahia", "BA"),
    ("Ceará", "CE"),
    ("Distrito Federal", "DF"),
    ("Espírito Santo", "ES"),
    ("Goiás", "GO"),
    ("Maranhão", "MA"),
    ("Mato Grosso", "MT"),
    ("Mato Grosso do Sul", "MS"),
    ("Minas Gerais", "MG"),
    ("Pará", "PA"),
    ("Paraíba", "PB"),
    ("Paraná", "PR"),
    ("Pernambuco", "PE"),
    ("Piauí", "PI"),
    ("Rio de Janeiro", "RJ"),
    ("Rio Grande do Norte", "RN"),
    ("Rio Grande do Sul", "RS"),
    ("Rondônia", "RO"),
    ("Roraima", "RR"),
    ("Santa Catarina", "SC"),
    ("São Paulo", "SP"),
    ("Sergipe", "SE"),
    ("Tocantins", "TO"),
)

# Snapshot folder for stations whose state could not be resolved.
UNKNOWN_REGION = "unknown"

# Page size of the observation API; page offsets are 1-based.
PAGE_LIMIT = 1000

# Default step of a custom-frequency period, in days.
DEFAULT_CUSTOM_DAYS = 7
