"""URL parts and duration text as column expressions.

``url_authority`` / ``url_key`` follow the split of Python's
``urllib.parse.urlparse``: the authority is what sits between ``//`` and the
next ``/``, ``?`` or ``#``; the path runs to the next ``?`` or ``#``; for the
schemes that carry ``;params`` the params of the last path segment are not
part of the path.  ``parse_url`` is not used because it returns NULL for any
URL the JVM's ``java.net.URI`` rejects (a space, a ``|``), where the Python
split still yields parts.  Where the Python split raises (a malformed
bracketed host such as ``http://[x/``), these return the parts as written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The split of a URL into scheme / authority / path.
URL_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
# Schemes whose last path segment may carry ";params"
# (Python's urllib.parse.uses_params list).
PARAM_SCHEMES = [
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
    "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _clean(url: Column | str) -> Column:
    """As the Python split does first: drop tab, CR and LF anywhere, and
    leading C0 controls and spaces."""
    return F.regexp_replace(F.regexp_replace(_col(url), "[\\t\\r\\n]", ""), "^[\\x00-\\x20]+", "")


def url_scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_clean(url), URL_SPLIT, 1))


def url_authority(url: Column | str) -> Column:
    """``netloc``: user, host and port as written (``HOST`` would drop them)."""
    return F.regexp_extract(_clean(url), URL_SPLIT, 2)


def url_path(url: Column | str) -> Column:
    u = _clean(url)
    raw = F.regexp_extract(u, URL_SPLIT, 3)
    return F.when(
        url_scheme(u).isin(PARAM_SCHEMES), F.regexp_replace(raw, ";[^/]*$", "")
    ).otherwise(raw)


def url_key(url: Column | str) -> Column:
    """Object key: the path without its leading slashes."""
    return F.regexp_replace(url_path(url), "^/+", "")


def format_hms(seconds: Column | str) -> Column:
    """``'<h>h <m>m <s>s'`` of a non-negative number of seconds (floored)."""
    s = _col(seconds).cast("double")
    h = F.floor(s / 3600)
    m = F.floor(F.pmod(s, F.lit(3600.0)) / 60)
    sec = F.floor(F.pmod(s, F.lit(60.0)))
    return F.format_string("%dh %dm %ds", h, m, sec)
