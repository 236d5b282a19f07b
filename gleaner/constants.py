"""Fixed values that results depend on, stated once."""

TRACKING_PREFIX = "utm_"
SAFE_SCHEMES = ("http", "https")
UNSAFE_REASONS = ("empty", "scheme", "no_host", "no_dot")
ID_LENGTH = 12
MAX_AGE_DAYS = 14
POOL_CAP = 600
QUOTE_CHARS = 300
QUOTE_LEAST = 60
UNKNOWN_TIER = 9
SHORTLIST = 20
PER_SOURCE, PER_DOMAIN = 2, 3
TITLE_JACCARD = 0.6
SHINGLE = 5
# Words without topical signal in titles (fixed values).
STOPWORDS = (
    "a an the and or but of for to in on at by with from as is are was were be been "
    "being it its this that these those how why what when who new now more most can "
    "could will would should may might must into over under about after before"
).split()
DEAD_STATUS = (404, 410)
RELATED = 4
CADENCE_DAYS = 21
HALF_LIFE_DAYS = 14.0
WEIGHTS = {"ai": 1.0, "tech": 0.8, "leadership": 0.6, "local-llm": 0.9, "harbour-events": 0.4}
