"""URL expressions: splitting, normalising, dates in paths, hosts and their suffixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Query parameters that only track where a visitor came from, for merging and for monitored lists.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "from", "share")
MONITOR_TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "from", "is_from_web", "share_token", "share_time", "spm", "tt_from", "oid", "ctype", "cid", "refer", "pos", "page", "_ref", "did",
)
#: Patterns of addresses that are no articles.
NOISE = (
    "/product/", "/products/", "/goods/", r"/item/\d+", "/sku/", "/cart", "/coupon", "/promotion/", "/category/", r"/search\?", "/jobs/", "/careers/",
    r"instagram\.com/", r"facebook\.com/", r"pinterest\.com/", r"twitter\.com/", r"x\.com/", "/download", "/app$", r"\.pdf$",
)
_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def url_part(url: Column, part: str) -> Column:
    """``scheme``, ``host``, ``path``, ``query`` (with its ?) or ``fragment``; lenient, empty where absent, null for null."""
    k = ("scheme", "host", "path", "query", "fragment").index(part) + 1
    out = F.regexp_extract(url, _PARTS, k)
    return F.lower(out) if part in ("scheme", "host") else out


def normalize_url(url: Column, query: str = "filter", drop: Sequence[str] = TRACKING, strip_www: bool = False, sort_query: bool = False, scheme: bool = True, root: str = "/") -> Column:
    """Canonical URL: lower scheme and host, no fragment, no trailing slash, ``root`` for an empty path.

    ``query``: ``keep`` it, ``drop`` it, or ``filter`` out the pairs of ``drop`` and those without ``=``. A string that
    is no absolute URL is only trimmed.
    """
    host = url_part(url, "host")
    host = F.regexp_replace(host, r"^www\.", "") if strip_www else host
    base = F.concat(F.concat(url_part(url, "scheme"), F.lit("://")) if scheme else F.lit(""), host, F.coalesce(F.nullif(F.rtrim(url_part(url, "path"), F.lit("/")), F.lit("")), F.lit(root)))
    given = F.substring(url_part(url, "query"), 2, 1 << 30)
    if query == "drop":
        tail = F.lit("")
    elif query == "keep":
        tail = F.when(given != "", F.concat(F.lit("?"), given)).otherwise("")
    else:
        pairs = F.filter(F.split(given, "&"), lambda p: p.contains("=") & ~F.lower(F.substring_index(p, "=", 1)).isin(*drop))
        pairs = F.array_sort(pairs) if sort_query else pairs
        tail = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise("")
    return F.when(F.regexp_extract(url, _PARTS, 2) != "", F.concat(base, tail)).otherwise(F.rtrim(F.trim(url), F.lit("/")))


def canonical_url(url: Column) -> Column:
    """Key of a monitored list's address: without www, fragment, tracking parameters (paging among them) and trailing
    slash, but for a path of the slash alone; an empty path stays empty.

    Parameters come by name, those of one name in their order; one without a value keeps its name. An address that begins
    with // is taken for https; any other without a scheme is only trimmed.
    """
    url = F.when(F.trim(url).startswith("//"), F.concat(F.lit("https:"), F.trim(url))).otherwise(url)
    host = F.regexp_replace(url_part(url, "host"), r"^www\.", "")
    path = url_part(url, "path")
    path = F.when(path == "/", path).otherwise(F.rtrim(path, F.lit("/")))
    name = lambda p: F.substring_index(p, "=", 1)
    pairs = F.filter(F.split(F.substring(url_part(url, "query"), 2, 1 << 30), "&"), lambda p: (p != "") & ~F.lower(name(p)).isin(*MONITOR_TRACKING))
    placed = F.array_sort(F.transform(pairs, lambda p, k: F.struct(name(p).alias("name"), k.alias("k"), F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))).alias("p"))))
    tail = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(F.transform(placed, lambda x: x["p"]), "&"))).otherwise("")
    return F.when(F.regexp_extract(url, _PARTS, 2) != "", F.concat(url_part(url, "scheme"), F.lit("://"), host, path, tail)).otherwise(F.rtrim(F.trim(url), F.lit("/")))


def page_key(url: Column) -> Column:
    """Scheme, lower host and path alone."""
    return normalize_url(url, query="drop")


def funnel_key(url: Column) -> Column:
    """Host and path of the whole address in lower case."""
    low = F.rtrim(F.lower(url), F.lit("/"))
    return F.when(url_part(low, "host") != "", F.concat(url_part(low, "host"), url_part(low, "path"))).otherwise(low)


def is_noise(url: Column, patterns: Sequence[str] = NOISE) -> Column:
    """A flag, not a filter."""
    return F.lower(url).rlike("|".join(patterns))


def links(html: Column, base: Column, least_title: int = 0, include: str | None = None, exclude: str | None = None) -> Column:
    """Array of (url, title) of a page's anchors: absolute or under the host of ``base``; whole markup is left out of titles.

    Anchors without title of ``least_title`` characters, or whose address doesn't match ``include`` or matches
    ``exclude``, are left out.
    """
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)(<a\s[^>]*>.*?</a>)"), F.lit(1))
    host = F.concat(url_part(base, "scheme"), F.lit("://"), url_part(base, "host"))

    def one(a: Column) -> Column:
        href = F.trim(F.regexp_extract(a, r"""(?i)\shref\s*=\s*["']([^"']*)["']""", 1))
        title = F.trim(F.regexp_replace(F.regexp_replace(a, r"<[^>]*>", " "), r"\s+", " "))
        return F.struct(F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("/"), F.concat(host, href)).alias("url"), title.alias("title"))

    def wanted(x: Column) -> Column:
        keep = x["url"].isNotNull() & (F.length(x["title"]) >= least_title)
        keep = keep & x["url"].rlike(include) if include else keep
        return keep & ~x["url"].rlike(exclude) if exclude else keep

    return F.filter(F.transform(anchors, one), wanted)


def url_date(url: Column, min_year: int = 2020, max_year: int = 2030, calendar: bool = True) -> Column:
    """Date in a URL path (/2024/05/06/, /2024-05-06, /20240506); null without one. ``calendar``: no 31 February."""
    out = F.lit(None).cast("string")
    for pattern in (r"/(\d{4})(\d{2})(\d{2})(?:\D|$)", r"/(\d{4})[/_-](\d{1,2})[/_-](\d{1,2})(?:\D|$)"):
        y, m, d = (F.regexp_extract(url, pattern, k) for k in (1, 2, 3))
        year, month, day = (x.try_cast("int") for x in (y, m, d))
        good = year.between(min_year, max_year) & month.between(1, 12) & day.between(1, 31)
        out = F.when(good, F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))).otherwise(out)
    return out.try_cast("date") if calendar else out


def match_hosts(df: DataFrame, host: str, tiers: DataFrame) -> DataFrame:
    """``df`` with the tier of its host: the entry of ``tiers`` (domain, tier, ord) that is the host, or else the first by
    ``ord`` that the host lies under.

    The host's suffixes are equi-joined with the domains, so no pair of a host and a domain is tried in vain.
    """
    hosts = df.select(host).distinct().where(F.col(host).isNotNull())
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.struct(F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("domain"), (k > 1).alias("under")))
    found = hosts.select(host, F.explode(suffixes).alias("s")).select(host, "s.domain", "s.under").join(tiers, "domain")
    best = found.groupBy(host).agg(F.min(F.struct("under", "ord", "domain", "tier")).alias("m")).select(host, F.col("m.domain").alias("domain"), F.col("m.tier").alias("tier"))
    return df.join(best, host, "left")
