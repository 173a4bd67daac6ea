"""URL functions, all of them built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom.functions.text import strip

#: scheme, authority, path, query (with ?), fragment (with #)
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, rf"(?s){_SPLIT}", group)


def _host_port(authority: Column) -> tuple[Column, Column]:
    """Lower-case host without brackets, and port as text ('' if none), of what follows any userinfo."""
    place = F.regexp_extract(authority, r"(?s)([^@]*)$", 1)
    bracketed = place.startswith("[")
    host = F.when(bracketed, F.regexp_extract(place, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_extract(place, r"^([^:]*)", 1))
    port = F.when(bracketed, F.regexp_extract(place, r"\]:(.*)$", 1)).otherwise(F.regexp_extract(place, r"^[^:]*:(.*)$", 1))
    return F.lower(host), port


def _decoded(c: Column) -> Column:
    """A query part decoded; one that is no valid encoding stays as it is but for its plus signs."""
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def _encoded(c: Column) -> Column:
    """Form encoding with ``~`` kept and ``*`` encoded."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column, tracking: Sequence[str] = C.TRACKING_KEYS) -> Column:
    """One spelling per address, the key by which citations are counted.

    Lower-case scheme and host, no userinfo, default port, fragment or tracking parameters, '/' for
    an empty path, parameters sorted and re-encoded (blank ones kept). Null stays null, blank gives
    '', and an address without a host or with an invalid port gives the stripped text itself.
    """
    raw = strip(url)
    scheme = F.lower(_part(raw, 1))
    host, port = _host_port(_part(raw, 2))
    number = F.when(port.rlike(r"^\d{1,5}$") & (port.try_cast("int") <= 65535), port.try_cast("int"))
    usual = ((scheme == "http") & (number == 80)) | ((scheme == "https") & (number == 443))
    place = F.when((port == "") | usual, host).otherwise(F.concat(host, F.lit(":"), number.cast("string")))
    path = F.when(_part(raw, 3) == "", F.lit("/")).otherwise(_part(raw, 3))
    pieces = F.filter(F.split(F.substr(_part(raw, 4), F.lit(2)), "&"), lambda p: p != "")
    pairs = F.transform(
        pieces, lambda p: F.struct(_decoded(F.regexp_extract(p, "(?s)^([^=]*)", 1)).alias("key"),
        _decoded(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("value"))
    )
    kept = F.filter(pairs, lambda p: ~(F.lower(strip(p["key"])).isin(*tracking) | F.lower(strip(p["key"])).startswith("utm_")))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encoded(p["key"]), F.lit("="), _encoded(p["value"]))), "&")
    whole = F.concat(
        F.when(scheme == "", F.lit("//")).otherwise(F.concat(scheme, F.lit("://"))), place,
        F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))
    )
    return F.when(raw == "", F.lit("")).when((host == "") | ((port != "") & number.isNull()), raw).otherwise(whole)


def domain(url: Column) -> Column:
    """Lower-case host without a leading 'www.'; '' where there is none, null for null."""
    host, _ = _host_port(_part(strip(url), 2))
    return F.regexp_replace(host, r"^www\.", "")


def site_name(url: Column) -> Column:
    """Like ``domain``, null where there is no host."""
    host, _ = _host_port(_part(url, 2))
    name = F.regexp_replace(host, r"^www\.", "")
    return F.when(name != "", name)
