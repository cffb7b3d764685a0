"""URL filters (operator 6): rules, and redirect equivalence for what no rule names.

Redirects and canonical links make their two addresses aliases. Distributed connected components over these edges give
the classes of aliases; a class with a member that a rule blocks is blocked, unless a rule allows a member: an explicit
allow goes first. A page that a rule fits follows its own rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A tag's attribute value in either quotes or none.
VALUE = """\\s*=\\s*(?:"([^"]*)"|'([^']*)'|([^\\s"'>]+))"""


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


def low(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path as written; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = low(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    some = F.coalesce(at > 0, F.lit(False))
    return F.when(some, host).otherwise(""), F.when(some, path).otherwise("")


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        told = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, told) if out is None else out.when(fits, told)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def address(url: Column) -> Column:
    """The node of a URL: scheme and host lowered, without fragment; null without ``://``."""
    at = F.instr(url, "://")
    whole = F.regexp_extract(F.trim(url), r"^([^#]*)", 1)
    head = F.regexp_extract(whole, r"^([^:]*://[^/?]*)", 1)
    return F.when(at > 0, F.concat(low(head), F.substring(whole, F.length(head) + 1, F.length(whole))))


def absolute(target: Column, base: Column) -> Column:
    """A link target as a full URL: absolute, scheme-relative, host-relative, query-only or folder-relative."""
    t = F.trim(F.regexp_replace(target, "&amp;", "&"))
    scheme = F.regexp_extract(base, r"^([^:]*:)//", 1)
    site = F.regexp_extract(base, r"^([^:]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(page, r"^([^:]*://.*/)[^/]*$", 1)
    folder = F.when(F.length(folder) > F.length(site), folder).otherwise(F.concat(site, F.lit("/")))
    return (
        F.when(t == "", None)
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
        .when(t.startswith("//"), F.concat(scheme, t))
        .when(t.startswith("/"), F.concat(site, t))
        .when(t.startswith("?"), F.concat(page, t))
        .when(t.startswith("#") | t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .otherwise(F.concat(folder, t))
    )


def _attribute(tag: Column, name: str) -> Column:
    found = rf"(?is)[\s\"']{name}{VALUE}"
    return F.concat(*[F.regexp_extract(tag, found, k) for k in (1, 2, 3)])


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): each page's address with its canonical link's and its refresh target's."""
    tags = lambda name: F.regexp_extract_all(F.col(html), F.lit(rf"(?is)(<{name}\s[^>]*>)"), 1)
    # most pages have neither: a plain search goes before the tags are taken apart
    likely = pages.filter(F.col(html).rlike("(?i)canonical|http-equiv") & F.col(url).isNotNull())
    link = likely.select(F.col(url).alias("u"), F.explode(tags("link")).alias("tag"))
    canonical = link.filter(low(_attribute("tag", "rel")).rlike(r"(^|\s)canonical(\s|$)")).select("u", _attribute("tag", "href").alias("t"))
    meta = likely.select(F.col(url).alias("u"), F.explode(tags("meta")).alias("tag")).filter(low(_attribute("tag", "http-equiv")) == "refresh")
    refresh = meta.select("u", F.regexp_extract(_attribute("tag", "content"), r"(?i)url\s*=\s*['\"]?\s*([^'\"]+)", 1).alias("t"))
    both = canonical.unionByName(refresh)
    return both.select(address(F.col("u")).alias("a"), address(absolute(F.col("t"), F.col("u"))).alias("b"))


def judge_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    ident: str = "page_id",
    url: str = "url",
    html: str | None = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, class_address) of every row.

    ``redirects``: more edges, two columns of URLs. Null URLs, and ones without ``://``, have an empty host and path;
    no rule fits them and they are allowed. Null html has no links; repeated rows and null ids are judged like others;
    an empty table gives no rows; other columns are ignored.
    """
    host, path = host_and_path(F.col(url))
    # the generator keeps Catalyst from writing these expressions out again in every rule's test
    parts = F.inline(F.array(F.struct(host.alias("host"), path.alias("path"), address(F.col(url)).alias("__node"))))
    judged = pages.select(F.col(ident).alias("page_id"), parts)
    judged = judged.withColumn("__rule", fitting_rule(F.col("host"), F.col("path"), rules))
    edges = page_links(pages, url, html) if html else None
    if redirects is not None:
        a, b = redirects.columns
        more = redirects.select(address(F.col(a)).alias("a"), address(F.col(b)).alias("b"))
        edges = more if edges is None else edges.unionByName(more)
    out = judged.withColumn("__told", F.lit(None).cast("string")).withColumn("class_address", F.col("__node"))
    if edges is not None:
        edges = materialise(edges.filter("a is not null and b is not null and a <> b").distinct(), "url-links")
        if not edges.isEmpty():
            classes = materialise(connected_components(edges, "url-classes"), "url-classes")
            h, p = host_and_path(F.col("node"))
            members = classes.select("component", F.inline(F.array(F.struct(h.alias("h"), p.alias("p")))))
            members = members.select("component", fitting_rule(F.col("h"), F.col("p"), rules)["verdict"].alias("v"))
            told = members.groupBy("component").agg(F.min("v").alias("__told"))  # allow sorts before block
            known = classes.join(told, "component").select(F.col("node").alias("__node"), "__told", F.col("component").alias("class_address"))
            named = judged.filter("__node is not null").join(known, "__node", "left").withColumn("class_address", F.coalesce("class_address", "__node"))
            out = named.unionByName(out.filter("__node is null"))  # pages without an address never meet in one task
    verdict = F.coalesce(F.col("__rule")["verdict"], F.col("__told"), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("__rule")["rule"].alias("rule"), verdict.alias("verdict"), "class_address")
