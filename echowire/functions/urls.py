"""Canonical URLs as Catalyst expressions over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.functions.strings import after, strip

# Query keys dropped from a canonical URL. Keys are lower-cased before the
# comparison, so the two mixed-case entries never match anything.
TRACKING_KEYS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "gclid", "fbclid", "msclkid", "dclid", "gclsrc",
    "_ga", "_gl", "mc_eid", "mc_cid",
    "ref", "referrer", "source", "campaign",
    "WT.mc_id", "WT.z_author", "ncid",
)

# Leading host labels that do not distinguish a site.
HOST_PREFIXES = ("www", "www2", "www3", "m", "mobile")

# Characters whose compatibility form holds one of / ? # @ : and which
# therefore make an authority invalid.
AMBIGUOUS_HOST_CHARS = (
    "\u2047\u2048\u2049\u2100\u2101\u2105\u2106\u2a74\ufe13\ufe16\ufe55\ufe56\ufe5f\ufe6b"
    "\uff03\uff0f\uff1a\uff1f\uff20"
)

_PREFIX = r"^(?:" + "|".join(HOST_PREFIXES) + r")\.(?=[^.]*\.)"
_STRAY_PERCENT = "%(?![0-9a-fA-F]{2})"


def _ipv6_pattern() -> str:
    """IPv6 literals: eight groups, or fewer around one `::`, the last two maybe dotted."""
    group = "[0-9a-f]{1,4}"
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    tail = rf"(?:{group}:{group}|{octet}(?:\.{octet}){{3}})"
    forms = [f"(?:{group}:){{6}}{tail}"]
    for before in range(7):
        head = f"(?:{group}(?::{group}){{{before - 1}}})" if before else ""
        room = 7 - before
        ends = [f"(?:{group}(?::{group}){{0,{room - 1}}})?"]
        if room >= 2:
            ends.append(f"(?:{group}:){{0,{room - 2}}}{tail}")
        forms.append(f"{head}::(?:{'|'.join(ends)})")
    forms.append(f"{group}(?::{group}){{6}}::")
    return "(?:" + "|".join(forms) + ")(?:%[^%]+)?"


_ASCII_AUTHORITY = r"^[\x00-Z\\^-\x7f]+\z"  # without brackets
_PLAIN_AUTHORITY = rf"^[^\[\]{AMBIGUOUS_HOST_CHARS}]+\z"
_BRACKETED_AUTHORITY = (
    rf"(?s)^(?!.*[{AMBIGUOUS_HOST_CHARS}])"
    rf"(?:.*@)?\[(?:v[0-9a-f]+\.[^\]]+|{_ipv6_pattern()})\](?::[^@]*)?\z"
)
# Groups: path, and `;params` of its last segment if not empty.
_PATH_PARAMS = r"(?s)^(.*/[^/;]*)((?:;[^/]+)?);?\z"
# Characters, or a second `=` in a field, that decoding or encoding would change.
_CODED = "[^a-z0-9_.~=&-]|=[^&]*="


def _resource(url: Column) -> Column:
    """What follows the scheme, up to the fragment, in lower case, without tabs and line ends."""
    bare = F.regexp_replace(strip(url), "^https?://", "")
    return F.substring_index(F.translate(F.lower(bare), "\t\r\n", ""), "#", 1)


def _valid(authority: Column) -> Column:
    forms = (_ASCII_AUTHORITY, _PLAIN_AUTHORITY, _BRACKETED_AUTHORITY)  # most frequent first
    return reduce(Column.__or__, (authority.rlike(form) for form in forms))


def _host(authority: Column) -> Column:
    """Authority without a default port and without one leading www-like label."""
    bare = F.regexp_replace(strip(authority), ":(?:80|443)$", "")
    return F.regexp_replace(bare, _PREFIX, "")


def _trimmed(path: Column) -> Column:
    """Path without trailing slashes, at least `/`; a path given is known to start with one."""
    bare = F.concat(F.lit("/"), F.rtrim(F.substr(path, F.lit(2)), F.lit("/")))
    return F.replace(bare, F.lit("%20"), F.lit(" "))


def _clean_path(path: Column) -> Column:
    """Trimmed path with the `;params` of its last segment put back behind it."""
    params = F.regexp_extract(path, _PATH_PARAMS, 2)
    split = F.concat(_trimmed(F.regexp_extract(path, _PATH_PARAMS, 1)), params)
    return F.when(F.instr(path, ";") == 0, _trimmed(path)).otherwise(split)


def _encode(text: Column) -> Column:
    encoded = F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))


def _ordered_fields(text: Column, decode: Callable, encode: Callable) -> Column:
    """Fields of a query without blank values and tracking keys, by key, then as given."""

    def parse(field: Column, position: Column) -> Column:
        name = F.substring_index(field, "=", 1)
        return F.struct(
            decode(name).alias("key"), position.alias("position"), decode(after(field, name)).alias("value")
        )

    fields = F.filter(
        F.transform(F.split(text, "&"), parse),
        lambda f: (f["value"] != "") & ~F.lower(f["key"]).isin(*TRACKING_KEYS),
    )
    parts = F.transform(
        F.sort_array(fields), lambda f: F.concat(encode(f["key"]), F.lit("="), encode(f["value"]))
    )
    return F.array_join(parts, "&")


def _clean_query(text: Column) -> Column:
    """Query decoded, rid of blank and tracking fields, ordered by key, encoded again.

    Most queries hold nothing that decoding or encoding would change; both are left out there.
    """
    escaped = F.regexp_replace(text, _STRAY_PERCENT, "%25")
    return (
        F.when(text == "", F.lit(""))
        .when(text.rlike(_CODED), _ordered_fields(escaped, F.try_url_decode, _encode))
        .otherwise(_ordered_fields(text, lambda part: part, lambda part: part))
    )


def with_canonical_url(df: DataFrame, url: str = "url", out: str = "canonicalUrl") -> DataFrame:
    """`df` plus the canonical form of its column `url`.

    NULL where the URL is blank or has no usable authority. The parts are columns of their
    own, so each is computed once per row, and each is read few times further up, so the
    expression stays small even where the optimizer moves a filter on the result below it.
    """

    def named(name: str) -> str:
        return f"__{out}_{name}"

    parts = ("resource", "target", "authority", "path", "rawquery", "query")
    resource, target, authority, path, rawquery, query = (F.col(named(p)) for p in parts)
    whole = F.concat(
        F.lit("https://"), _host(authority), _clean_path(path),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )
    return (
        df.withColumn(named("resource"), _resource(F.col(url)))
        .withColumn(named("target"), F.substring_index(resource, "?", 1))
        .withColumns({
            named("authority"): F.substring_index(target, "/", 1),
            named("rawquery"): after(resource, target),
        })
        .withColumn(named("path"), F.substr(target, F.length(authority) + 1))
        .withColumn(named("query"), _clean_query(rawquery))
        .withColumn(out, F.when(_valid(authority), whole))
        .drop(*map(named, parts))
    )


def domain_of(canonical: Column | str) -> Column:
    """Normalised authority of a canonical URL, NULL for NULL."""
    canonical = F.col(canonical) if isinstance(canonical, str) else canonical
    return F.regexp_extract(canonical, "^https://([^/?#]*)", 1)


def urls_match(canonical_1: Column, canonical_2: Column) -> Column:
    """True when both canonical forms exist and are equal."""
    return F.coalesce(canonical_1 == canonical_2, F.lit(False))


def url_score(canonical_1: Column, canonical_2: Column) -> Column:
    return F.when(urls_match(canonical_1, canonical_2), 1.0).otherwise(0.0)
