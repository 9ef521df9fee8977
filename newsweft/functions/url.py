"""URL identity, spellings, admission and article type as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def canonical(url: Column, prefix: str = "") -> Column:
    """Scheme, host and path only; a configured prefix and one trailing slash go."""
    out = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    if prefix:
        out = F.replace(out, F.lit(prefix), F.lit(""))
    return F.regexp_replace(out, r"/$", "")


def identity(url: Column) -> Column:
    """What does not change between spellings of one address: host without www, path, no scheme."""
    return F.regexp_replace(F.regexp_replace(canonical(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"^www\.", "")


def spellings(url: Column) -> Column:
    """The address under both schemes, with and without www."""
    rest = identity(url)
    forms = [F.concat(F.lit(f"{s}://{w}"), rest) for s in ("https", "http") for w in ("", "www.")]
    return F.array_distinct(F.array(url, *forms))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#:]+)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]+(/[^?#]*)?", 1)


def admitted(url: Column, domain: Column, banned_subdomains: list[str] = (), banned_parts: list[str] = ()) -> Column:
    """Same registered domain, no banned subdomain, no banned part anywhere in the address."""
    at = host(url)
    bare = F.regexp_replace(F.lower(domain), r"^www\.", "")
    ok = (at == bare) | F.endswith(at, F.concat(F.lit("."), bare))
    for sub in banned_subdomains:
        ok = ok & (at != F.concat(F.lit(f"{sub}."), bare))
    for part in banned_parts:
        ok = ok & ~F.contains(url, F.lit(part))
    return F.coalesce(ok, F.lit(False))


def article_type(url: Column) -> Column:
    """opinion if a path segment says so, hard news otherwise, unknown without a usable address."""
    parts = F.split(F.lower(path(url)), "/")
    return (
        F.when(url.isNull() | (F.trim(url) == "") | (host(url) == ""), "unknown")
        .when(F.array_contains(parts, "opinion") | F.array_contains(parts, "opinions"), "opinion")
        .otherwise("hard news")
    )
