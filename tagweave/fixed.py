"""Values that results depend on. Change them and the answers change."""

# --- fixed values: title keywords, as one regular-expression alternation ---
VARIANT_KEYWORDS = (
    "deluxe|remaster(?:ed)?|remix(?:es)?|edition|version|bonus|expanded|"
    "anniversary|original|explicit|clean"
)

# --- fixed values: what counts as a variant suffix of a normalized title ---
BRACKETED_SUFFIX = rf"\s*[\[(].*?(?:{VARIANT_KEYWORDS}).*?[\])]$"
TRAILING_SUFFIX = rf"\s+(?:{VARIANT_KEYWORDS})\.?$"

# --- fixed values: tags that describe a content version, never a style ---
CONTENT_VERSION_TAGS = [
    "explicit",
    "explicit lyrics",
    "explicit content",
    "clean",
    "clean lyrics",
    "clean version",
]

# --- fixed values: community tags that carry no information ---
NOISE_TAGS = [
    "seen live", "albums i own", "favorite", "me",
    "own", "owned", "cover", "remix", "reissue", "soundtrack",
    "needs work", "untagged", "to listen", "loved",
]
MIN_CRAWL_TAG_LENGTH = 3
MAX_SIMILAR = 12

# --- fixed values: scoring ---
PRIMARY_WEIGHT = 1.5
OTHER_WEIGHT = 0.5
CONFIDENCE_TARGET = 7

# --- fixed values: feature map prefixes and weights ---
PRIMARY_PREFIX, PRIMARY_FEATURE_WEIGHT = "primary_", 4.0
SECONDARY_PREFIX, SECONDARY_FEATURE_WEIGHT = "secondary_", 2.0
DESCRIPTOR_PREFIX, DESCRIPTOR_FEATURE_WEIGHT = "descriptor_", 2.0
TAG_PREFIX = "tag_"

# --- fixed values: list columns ---
MISSING_LIST = "NA"

# --- fixed values: external records ---
EXTERNAL_SOURCE = "lastfm"
DEFAULT_SOURCE = "rym"
EXTERNAL_RELEASE_TYPE = "album"
EXTERNAL_DESCRIPTORS = 30

# --- fixed values: request limits ---
RECOMMEND_DEFAULT, RECOMMEND_MAX = 50, 5000
SUGGEST_DEFAULT, SUGGEST_MAX = 10, 50
MIN_QUERY_LENGTH = 2

# --- fixed values: display ---
DISPLAY_DESCRIPTORS = 8
