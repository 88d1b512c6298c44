"""URL helpers."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def url_key(url: Column) -> Column:
    """Storage key of a URL."""
    return F.md5(url)


def authority(url: Column) -> Column:
    """Host and port. Unlike a strict URI parser this also works on links with odd characters."""
    return F.regexp_extract(url, r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def _join(base: str, href: str | None) -> str | None:
    try:
        return urljoin(base, href).strip("/")
    except ValueError:
        return None


@F.pandas_udf(T.ArrayType(T.StringType()))
def resolve_links(url: pd.Series, hrefs: pd.Series) -> pd.Series:
    """Absolute form of all links of a page, one call per page.

    Spark has no RFC 3986 resolver; this is one of the two places where Python rows are needed.
    A link without target resolves to the page itself.
    """
    return pd.Series([
        None if base is None or found is None else [_join(base, h) for h in found]
        for base, found in zip(url, hrefs)
    ])
