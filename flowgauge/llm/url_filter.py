"""URL rules whose decisions hold for all addresses of a page.

Pages that redirect to one another or name one another as canonical are one page under
several addresses.  Connected components over those links carry a block decision to
all aliases; an explicit allow comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import col
from flowgauge.llm.graph import components

#: (verdict, rule): a host, with all its subdomains, and the start of a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>;]+)"""


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(of_host: Column, of_path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null if none fits."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = rule.partition("/")
        fits = (of_host == name) | F.endswith(of_host, F.lit(f".{name}"))
        fits &= F.startswith(of_path, F.lit(slash + start))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def address(url: Column) -> Column:
    """What identifies an address: without the fragment, scheme and host in lower case."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    front = F.regexp_extract(bare, r"(?s)^.*?://[^/?]*", 0)
    return F.concat(F.translate(front, _UPPER, _LOWER), F.substr(bare, F.length(front) + 1))


def resolved(base: Column, link: Column) -> Column:
    """A link as found on page ``base``, made absolute; null if the page has no absolute address."""
    front = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    scheme = F.regexp_extract(base, r"(?s)^(.*?):", 1)
    folder = F.regexp_extract(path(base), r"(?s)^(.*/)", 1)
    return F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(
        front != "",
        F.when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(front, link))
        .when(F.startswith(link, F.lit("#")), base)
        .when(F.startswith(link, F.lit("?")), F.concat(front, path(base), link))
        .otherwise(F.concat(front, F.when(folder == "", F.lit("/")).otherwise(folder), link)),
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses that the html's canonical link or refresh redirect makes one."""
    text = col(html)
    canonical = F.regexp_extract(F.regexp_extract(text, CANONICAL, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract(text, REFRESH, 0), REFRESH_URL, 1)
    found = pages.select(col(url).alias("url"), F.explode(F.array(canonical, refresh)).alias("link")).where("link <> ''")
    return found.select(
        address(F.col("url")).alias("a"), address(resolved(F.col("url"), F.col("link"))).alias("b")
    ).where("a is not null and b is not null")


def url_verdicts(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    redirects: DataFrame | None = None,
    rules=RULES,
    default: str = "allow",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row.

    A page that a rule fits has the longest rule's verdict.  Any other is allowed if an
    alias is explicitly allowed, else blocked if an alias is blocked, else gets
    ``default``.  ``redirects`` are further links, columns (a, b) of addresses.  Link
    targets that are no page count as aliases too.  A null url, or one without
    ``://``, has empty host and path, no rule and no alias; null html has no links.
    Repeated rows come out as often as they came in.
    """
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b")))
    aliases = components(links)
    found = longest_rule(host(F.col("node")), path(F.col("node")), rules).getField("verdict")
    decided = (
        aliases.select("component", found.alias("verdict"))
        .groupBy("component")
        .agg(F.max(F.col("verdict") == "allow").alias("allowed"), F.max(F.col("verdict") == "block").alias("blocked"))
        .where("allowed or blocked")
        .select("component", F.when(F.col("allowed"), "allow").otherwise("block").alias("of_aliases"))
    )
    by_node = aliases.join(decided, "component").select("node", "of_aliases")
    rows = pages.select(col(id).alias("id"), col(url).alias("url")).select(
        "id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), address(F.col("url")).alias("node")
    )
    ruled = rows.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    return ruled.join(by_node, "node", "left").select(
        F.col("id").alias(id),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", "of_aliases", F.lit(default)).alias("verdict"),
    )
