"""Fixed values that define what a file reference is and how it is classed.

Everything in this module is a *fixed value*: the extraction and
classification results depend on these exact strings, so they are stated
plainly, in the order they are tried, and nowhere else.
"""

# ---------------------------------------------------------------------------
# URL patterns (Java regex syntax, as used by Spark).
#
# BARE_URL: "http://" or "https://" followed by one or more characters that
#   are not whitespace, a double or single quote, or one of ( ) [ ] { }.
# KEYED_URL: a JSON member named exactly "url" (lower case) whose string value
#   starts with http:// or https://; group 1 is the value up to the next quote.
#
# "Whitespace" is Unicode whitespace plus the four separator controls
# U+001C..U+001F.  Java's (?U) flag gives Unicode \s; the controls are added
# explicitly because Java does not count them as whitespace.
# ---------------------------------------------------------------------------
BARE_URL = r"""(?U)https?://[^\s\x1c-\x1f"'\)\(\[\]\{\}]+"""
KEYED_URL = r"""(?U)"url"[\s\x1c-\x1f]*:[\s\x1c-\x1f]*"(https?://[^"]+)\""""
KEYED_URL_GROUP = 1

# The same two patterns for an RE2 engine (DuckDB oracle).  RE2 has ASCII \s
# and reads (?U) as "ungreedy", so these agree with the Java forms on ASCII
# input only.  Used in oracle SQL, never in the library itself.
BARE_URL_RE2 = r"""https?://[^\s\x1c-\x1f"'()\[\]{}]+"""
KEYED_URL_RE2 = r""""url"[\s\x1c-\x1f]*:[\s\x1c-\x1f]*"(https?://[^"]+)\""""

# Both patterns need this literal; a line without it cannot yield a reference.
URL_MARKER = "http"

# ---------------------------------------------------------------------------
# Network classes, first match wins, case-insensitive substring.
# ---------------------------------------------------------------------------
IN_NETWORK = "in-network"
ALLOWED_AMOUNT = "allowed-amount"
OTHER = "other"
NETWORK_RULES = [
    ("in-network", IN_NETWORK),
    ("allowed-amount", ALLOWED_AMOUNT),
]

# ---------------------------------------------------------------------------
# File types, first match wins, case-sensitive suffix.
# ---------------------------------------------------------------------------
UNKNOWN_TYPE = "unknown"
FILE_TYPE_RULES = [
    (".json.gz", "json.gz"),
    (".csv.gz", "csv.gz"),
    (".json", "json"),
    (".csv", "csv"),
    (".gz", "gz"),
]

# ---------------------------------------------------------------------------
# Defaults of the extraction job.
# ---------------------------------------------------------------------------
DEFAULT_ENTITY_TYPE = "payer"
DEFAULT_BATCH_SIZE = 10_000
SAMPLE_SIZE = 20
RESULT_SAMPLE_SIZE = 15
