"""Parts of a URL as column expressions: NULL where a part is absent; parameter names match whole."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnLike, as_column

# Schemes taken off the start of a URL.
SCHEMES = ("android-app://", "http://", "https://")


def _rest(url: ColumnLike) -> Column:
    """The URL without its scheme; one further on belongs to the path or query."""
    return F.regexp_replace(as_column(url), "^(?:" + "|".join(map(re.escape, SCHEMES)) + ")", "")


def url_host(url: ColumnLike) -> Column:
    """Everything up to the first '/' or '?'; a port or fragment stays."""
    return F.regexp_extract(_rest(url), "^([^/?]*)", 1)


def url_path(url: ColumnLike) -> Column:
    """Text after the first '/' up to '?', without the slash; a fragment stays."""
    rest = _rest(url)
    return F.when(rest.rlike("^[^?]*/"), F.regexp_extract(rest, r"^[^/?]*/([^?]*)", 1))


def url_parameter(url: ColumnLike, name: str) -> Column:
    """Value of a query parameter, NULL if absent or empty."""
    return F.nullif(F.regexp_extract(as_column(url), f"[?&]{re.escape(name)}=([^&#]*)", 1), F.lit(""))
