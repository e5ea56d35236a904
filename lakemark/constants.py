"""Values the results depend on.

Fixed values: field names, codes, formats and limits below decide what the
reports contain, so they are stated here once, as they must be.
"""

# Fields of an event document.
COUNTRY_FIELD = "country_txt"
YEAR_FIELD = "iyear"
CLAIMANT_FIELD = "gname"

# Columns of a document without a schema: the whole of it, and the names of its fields.
DOCUMENT = "document"
DOCUMENT_FIELDS = "document_fields"

# A claimant with this text counts as "nobody claimed it".
UNKNOWN_CLAIMANT = "Unknown"

# Indicator codes of the two stock indicator reports.
ENERGY_CODE = "EG.ELC.PETR.ZS"
DEFENSE_CODE = "MS.MIL.XPND.GD.ZS"

# Layout of a wide indicator line, counted in quoted tokens.
TOKENS_PER_LINE = 61
FIRST_SERIES_TOKEN = 4

# Column profiling. A group with one of these texts (or a null)
# is a sentinel; a key candidate has at most one such group and at least five
# groups in all.
SENTINEL_TEXTS = ("null", "0")
MAX_SENTINEL_GROUPS = 1
MIN_GROUPS = 5
DEFAULT_KEY_COLUMN = 0

# Delimiters the parametric join accepts.
COMMA = ","
SEMICOLON = ";"

# Field names of the stored documents.
DOC_COUNT = "NumOfAttacks"
DOC_COUNTRIES = "Countries"
DOC_YEARS = "Years"
DOC_GROUPS = "GroupName"
DOC_PART = "Part"
DOC_COUNTRY = "Country"
DOC_ENERGY_MEAN = "Average Production of Energy"
DOC_DEFENSE_MEAN = "Average expenditure for Defense"
DOC_COLUMN_NUMBER = "Column Number"
DOC_DIFFERENT_VALUES = "Different Values"
DOC_KEY_COLUMN = "Key Column"
