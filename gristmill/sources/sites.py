"""Items of list pages by site: state objects in scripts, JSON-LD, published times of meta and time tags, or else links."""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEMS = "url string, title string, published string, origin string"
_SCRIPT_LD = re.compile(r"<script\b[^>]*\bapplication/ld\+json\b[^>]*>(.*?)</script\s*>", re.I | re.S)
_TAG = re.compile(r"<[^<>]*>")
_LINK = re.compile(r"<a\b([^<>]*)>(.*?)</a\s*>", re.I | re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
_META = re.compile(r"<(meta|time)\b([^<>]*)>", re.I)
#: Fixed names of meta tags that hold the time of publication, the first the strongest.
PUBLISHED = ("article:published_time", "datepublished", "publishdate", "pubdate", "date")


def _attributes(tag: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(tag)}


def published_of(page: str) -> str | None:
    """The time of publication that a page's meta tags state, the strongest name first, else that of its first time tag."""
    named, timed = {}, None
    for m in _META.finditer(page):
        a = _attributes(m[2])
        if m[1].lower() == "time":
            timed = timed or a.get("datetime")
        elif content := a.get("content"):
            named.setdefault((a.get("property") or a.get("name") or a.get("itemprop") or "").lower(), content)
    return next((named[n] for n in PUBLISHED if n in named), timed)


def _state(page: str, variable: str, path: list[str]) -> list:
    """The list at ``path`` of the object that a script assigns to ``window.variable``."""
    for m in re.finditer(rf"window\.{re.escape(variable)}\s*=\s*(?=\{{)", page):
        try:
            held, _ = json.JSONDecoder().raw_decode(page, m.end())
        except ValueError:
            continue
        for name in path:
            held = held.get(name) if isinstance(held, dict) else None
        if isinstance(held, list):
            return [x for x in held if isinstance(x, dict)]
    return []


def _linked_data(page: str) -> Iterator[dict]:
    for m in _SCRIPT_LD.finditer(page):
        try:
            held = json.loads(m[1])
        except ValueError:
            continue
        todo = held if isinstance(held, list) else [held]
        for x in todo:
            if isinstance(x, dict):
                yield from (g for g in x.get("@graph", [x]) if isinstance(g, dict))


def items_of(page: str, base: str, sites: list[dict]) -> list[tuple[str, str, str | None, str]]:
    """(url, title, published, origin) of a page's items: of its site's state object, else of JSON-LD articles, else links."""
    host = (urlsplit(base).hostname or "") if base else ""
    site = next((s for s in sites if host == s["host"] or host.endswith("." + s["host"])), {})
    found, seen = [], set()

    def add(url: object, title: object, published: object, origin: str) -> None:
        title = " ".join(entities.unescape(_TAG.sub("", str(title or ""))).split())
        if url and len(title) >= site.get("least_title", 1) and (url := urljoin(base or "", str(url))) not in seen:
            seen.add(url)
            found.append((url, title, str(published) if published else None, origin))

    if "state" in site:
        for x in _state(page, site["state"], site["path"]):
            if x.get(site["id"]) is not None:
                add(site["url"].format(x[site["id"]]), x.get(site["title"]), x.get(site.get("published", "")), "state")
    if not found:
        for x in _linked_data(page):
            if x.get("headline"):
                add(x.get("url") or base, x["headline"], x.get("datePublished"), "json-ld")
    if not found:
        when = published_of(page)
        for m in _LINK.finditer(page):
            href = _attributes(m[1]).get("href", "").strip()
            if href and not href.startswith(("#", "javascript:", "mailto:")) and all(p in href for p in site.get("links", [])):
                add(href, m[2], when, "link")
    return found


@F.udtf(returnType=ITEMS)
class _SiteItems:
    def eval(self, page: str, base: str, sites: str):
        yield from items_of(page or "", base or "", json.loads(sites))


def site_items(pages: DataFrame, sites: list[dict], html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` beside the items (item_url, title, published, origin) of each, chosen by host.

    A site has a ``host`` (its subdomains count) and may have ``state``, the variable of its state object, with ``path``
    to the list, the fields ``id``, ``title`` and ``published`` of items and the form of their ``url``; ``links``, parts
    that addresses must hold; ``least_title``. Null and empty pages have no items; an address is listed once a page.
    """
    found = _SiteItems(F.col(html).outer(), F.col(url).outer(), F.lit(json.dumps(sites)))
    return pages.lateralJoin(found.withColumnRenamed("url", "item_url"))
