"""Fixed values that must equal the reference's for right results.

Everything in this module is data, stated plainly and in the reference's own
order; the logic that uses it lives in :mod:`watchfold.functions.columns`.
"""

# --- fixed values: app name -> watch category (exact, case-sensitive match) ---
APP_CATEGORIES = {
    "TV_Channel": ["CHANNEL", "DSHD", "KPLUS", "KPlus"],
    "Movies": ["VOD", "FIMS_RES", "BHD_RES", "VOD_RES", "FIMS", "BHD", "DANET"],
    "Entertainment": ["RELAX"],
    "Kids": ["CHILD"],
    "Sports": ["SPORT"],
}
# Category for any other app name, NULL included.
UNKNOWN_CATEGORY = "Error"

# --- fixed values: the five pivot columns of the interaction fact ---
PROGRAM_TYPES = ["Entertainment", "Kids", "Movies", "Sports", "TV_Channel"]

# --- fixed values: placeholder contracts dropped from the interaction fact ---
PLACEHOLDER_CONTRACTS = ["0", ""]

# --- fixed values: active-day bins, lower bound inclusive, upper exclusive ---
ACTIVE_DAY_BINS = [
    (0, 5, "0-5"),
    (5, 10, "5-10"),
    (10, 15, "10-15"),
    (15, 20, "15-20"),
    (20, 25, "20-25"),
    (25, 30, "25-30"),
]
ACTIVE_DAY_TOP_BIN = "30"          # everything else that is not NULL, negatives too
ACTIVE_DAY_UNKNOWN_BIN = "Unknown"  # NULL active days

# --- fixed values: program-name synonyms accepted by the top-k report ---
PROGRAM_SYNONYMS = {
    "entertainment": "Entertainment",
    "kids": "Kids",
    "movies": "Movies",
    "sports": "Sports",
    "tv_channel": "TV_Channel",
    "tv channel": "TV_Channel",
    "tvchannel": "TV_Channel",
    "tv": "TV_Channel",
}

# --- fixed values: the closed list of genres a keyword may be labelled with ---
GENRES = [
    "Action", "Romance", "Comedy", "Horror", "Animation", "Drama", "C Drama",
    "K Drama", "Sports", "Music", "Reality Show", "TV Channel", "News", "Other",
]
DEFAULT_GENRE = "Other"
LABEL_BATCH_SIZE = 150

# --- fixed values: the labelling prompt's worked examples (exact keyword -> genre) ---
GENRE_EXAMPLES = {
    "thuyếtminh": "Other",
    "bigfoot": "Horror",
    "capdoi": "Romance",
    "ARGEN": "Sports",
    "nhật ký": "Drama",
    "PENT": "C Drama",
    "running": "Reality Show",
    "VTV3": "TV Channel",
}

# --- fixed values: the prompt's quick rules, in its order (case-insensitive substrings) ---
GENRE_RULES = [
    (["VTV", "HTV", "Channel"], "TV Channel"),
    (["running", "master key", "reality"], "Reality Show"),
    (["sex", "romantic", "love"], "Romance"),
    (["potter", "hogwarts"], "Drama"),
]

# --- fixed values: bridge-table dates, links per user and per contract ---
BRIDGE_START_DATE = "2022-04-01"
BRIDGE_END_DATE = "2026-12-12"
BRIDGE_MAX_LINKS = 5

# Every category a log row can get, sorted by name (binary string order), which is
# the order ``sort_array`` gives and the tie-break order for the most-watched type.
WATCH_TYPES = sorted([*APP_CATEGORIES, UNKNOWN_CATEGORY])
