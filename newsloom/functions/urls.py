"""URL joining and request URLs as native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import bind, groups, strip

# RFC 3986, appendix B, with a strict scheme: scheme, authority, path, query, fragment
_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# Schemes whose references are resolved against a base (fixed values).
HIERARCHICAL = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)


def _parts(url: Column) -> Column:
    """Array of the five components, from one regular expression; absent ones are empty."""
    return groups(url, _URL, 5)


def _tidy(url: Column) -> Column:
    """Drop the control characters a URL may not hold."""
    return F.when(
        url.rlike(r"[\x00-\x20]"),
        F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", ""),
    ).otherwise(url)


def _fold(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` segments into a path."""
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, seg: F.when(seg == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(seg == ".", kept)
        .otherwise(F.array_append(kept, seg)),
    )
    last = F.element_at(segments, -1)
    closed = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    path = F.array_join(closed, "/")
    return F.when(path == "", F.lit("/")).otherwise(path)


def _compose(scheme: Column, netloc: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = F.when((netloc != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(F.lit("")),
        rooted,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )


def _resolve(base: Column, ref: Column) -> Column:
    """Join a reference to a base, both given as component arrays."""
    netloc, path, query, fragment = ref[1], ref[2], ref[3], ref[4]
    scheme, base_netloc, base_path = F.lower(base[0]), base[1], base[2]
    rooted = path.startswith("/")
    plain = rooted & ~path.rlike(r"/\.\.?(/|$)")
    levels = F.split(base_path, "/", -1)
    above = F.when(F.element_at(levels, -1) == "", levels).otherwise(F.slice(levels, 1, F.size(levels) - 1))
    relative = bind(F.concat(above, F.split(path, "/", -1)), _without_inner_blanks)
    resolved = F.when(plain, path).otherwise(
        bind(F.when(rooted, F.split(path, "/", -1)).otherwise(relative), _fold)
    )
    same_query = F.when(query != "", query).otherwise(base[3])
    return (
        F.when(netloc != "", _compose(scheme, netloc, path, query, fragment))
        .when(path == "", _compose(scheme, base_netloc, base_path, same_query, fragment))
        .otherwise(bind(resolved, lambda p: _compose(scheme, base_netloc, p, query, fragment)))
    )


def _without_inner_blanks(segments: Column) -> Column:
    inner = F.filter(F.slice(segments, 2, F.greatest(F.size(segments) - 2, F.lit(0))), lambda s: s != "")
    ends = F.concat(F.slice(segments, 1, 1), inner, F.slice(segments, -1, 1))
    return F.when(F.size(segments) > 2, ends).otherwise(segments)


def _join(base: Column, ref: Column) -> Column:
    def joined(pair: Column) -> Column:
        own, other = F.lower(pair["ref"][0]), F.lower(pair["base"][0])
        foreign = ((own != "") & (own != other)) | ~other.isin(*HIERARCHICAL)
        return F.when(foreign, pair["text"]).otherwise(_resolve(pair["base"], pair["ref"]))

    parsed = F.struct(_parts(base).alias("base"), _parts(ref).alias("ref"), ref.alias("text"))
    return bind(parsed, joined)


def origin_base(base: Column) -> Column:
    """A full-URL default base is cut to ``scheme://host/``; other text stays as it is."""

    def cut(text: Column) -> Column:
        scheme, netloc = F.lower(_parts(text)[0]), _parts(text)[1]
        full = (scheme != "") & (netloc != "")
        return F.when(full, F.concat(scheme, F.lit("://"), netloc, F.lit("/"))).when(text != "", text)

    return bind(strip(base), cut)


def to_absolute(url: Column, base: Column | None = None, default_base: Column | None = None) -> Column:
    """Absolute form of ``url`` against the base, else the default base, else unchanged.

    A blank URL gives null, which callers turn into an invalid item.
    """
    page = strip(base) if base is not None else F.lit(None).cast("string")
    chosen = bind(page, lambda text: F.when(text != "", text))
    if default_base is not None:
        chosen = F.coalesce(chosen, origin_base(default_base))

    def joined(pair: Column) -> Column:
        ref, root = pair["ref"], pair["base"]
        return (
            F.when(ref.isNull() | (ref == ""), F.lit(None))
            .when(root.isNull(), ref)
            .otherwise(_join(_tidy(root), _tidy(ref)))
        )

    return bind(F.struct(strip(url).alias("ref"), chosen.alias("base")), joined)


# Query parameters that only track where a reader came from (fixed values); names ending in `*`
# stand for all that begin so.
TRACKING = ("utm_*", "gclid", "fbclid", "msclkid", "dclid", "yclid", "igshid", "mc_cid", "mc_eid", "_ga", "_gl")
_DEFAULT_PORTS = {"http": "80", "https": "443"}


def _percent(text: Column) -> Column:
    """Percent codes in capitals, those of unreserved characters decoded, a stray ``%`` coded."""

    def piece(part: Column, i: Column) -> Column:
        code = F.upper(F.substring(part, 1, 2))
        char = F.char(F.conv(code, 16, 10).cast("int"))
        rest = F.substr(part, F.lit(3))
        coded = F.when(char.rlike("^[A-Za-z0-9._~-]$"), F.concat(char, rest)).otherwise(F.concat(F.lit("%"), code, rest))
        return F.when(i == 0, part).when(code.rlike("^[0-9A-F]{2}$"), coded).otherwise(F.concat(F.lit("%25"), part))

    return F.when(text.contains("%"), F.array_join(F.transform(F.split(text, "%", -1), piece), "")).otherwise(text)


def _tracked(name: Column, tracking: Sequence[str]) -> Column:
    exact = [t for t in tracking if not t.endswith("*")]
    found = name.isin(*exact) if exact else F.lit(False)
    for start in (t[:-1] for t in tracking if t.endswith("*")):
        found = found | name.startswith(start)
    return found


def canonical_url(url: Column, tracking: Sequence[str] = TRACKING) -> Column:
    """One form of all addresses of a page.

    Scheme and host in lower case, no default port, dot segments resolved, percent codes in one
    form, query parameters sorted and without the ``tracking`` ones, no fragment. An address that
    is not http(s) is only stripped; a blank one is null. Applying it again changes nothing.
    """
    tracking = [t.lower() for t in tracking]

    def built(part: Column) -> Column:
        scheme, netloc = F.lower(part[0]), part[1]
        user = F.regexp_extract(netloc, "^(.*@)", 1)
        host = F.lower(F.regexp_replace(netloc, "^.*@", ""))
        for name, port in _DEFAULT_PORTS.items():
            host = F.when(scheme == name, F.regexp_replace(host, f":(?:{port})?$", "")).otherwise(host)
        path = bind(_percent(part[2]), lambda p: F.when(p.rlike(r"(^|/)\.\.?(/|$)"), bind(F.split(p, "/", -1), _fold)).otherwise(p))
        pairs = F.transform(F.filter(F.split(part[3], "&", -1), lambda q: q != ""), _percent)
        kept = F.filter(pairs, lambda q: ~_tracked(F.lower(F.substring_index(q, "=", 1)), tracking))
        query = F.array_join(F.array_sort(kept), "&")
        rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
        return F.concat(scheme, F.lit("://"), user, host, rooted, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))

    def chosen(text: Column) -> Column:
        web = text.rlike(r"^(?i)https?://[^/?#]")
        return F.when(web, bind(_parts(text), built)).when(text != "", text)

    return bind(_tidy(strip(url)), chosen)


def request_url(url: Column, params: Column) -> Column:
    """``url`` with the ``array<struct<key,value>>`` of query parameters appended in order.

    Parameters go before a fragment, which stays at the end.
    """
    pairs = F.transform(
        params,
        lambda p: F.concat(F.url_encode(p["key"]), F.lit("="), F.url_encode(F.coalesce(p["value"], F.lit("")))),
    )
    before = F.substring_index(url, "#", 1)
    fragment = F.substr(url, F.char_length(before) + 1)
    mark = F.when(F.instr(before, "?") > 0, F.lit("&")).otherwise(F.lit("?"))
    extended = F.concat(before, mark, F.array_join(pairs, "&"), fragment)
    return F.when(F.coalesce(F.size(params), F.lit(0)) > 0, extended).otherwise(url)


__all__ = ["HIERARCHICAL", "TRACKING", "canonical_url", "origin_base", "request_url", "to_absolute"]
