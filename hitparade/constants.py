"""Fixed values.

These must equal the reference's for the same results; every module takes
them from here.
"""

# extraction
ALL_GENRES_ID = 0
REQUIRED_TRACK_FIELDS = ("id", "title", "duration", "rank", "artist_id")

# Raw path partition segment
DATE_PARTITION_PATTERN = r"date=(\d{4}-\d{2}-\d{2})"

# Quality rules
UNIQUENESS_KEY = ("id_titre", "date_snapshot")
COMPLETENESS_THRESHOLD = 0.98
BPM_RANGE = (0.0, 300.0)

# reports
TOP_K = 20
EMERGING_MAX_FANS = 500_000

# Retention of the raw zone (the curated zone never expires)
RAW_RETENTION_DAYS = 100
