"""URL filter with redirect equivalence, in DataFrame functions only.

Rules (allow or block, each ``host/path``) are judged first: a rule fits its
host and all subdomains when the URL's path starts with the rule's path; the
longest rule wins, and of two equally long ones the one that allows.

URLs no rule fits get their verdict through their aliases: redirect and
canonical-link edges join URLs into connected components (distributed, see
``components``). A component with a URL that is explicitly allowed is
allowed; otherwise one with a blocked URL is blocked; otherwise the default
holds. URLs are the same node up to their fragment and the case of scheme
and host.

The rules are a short policy list that becomes one expression in the plan;
``MAX_RULES`` bounds it. URLs, edges and components stay in Spark tables.

Defined results: a null URL or one without ``://`` has empty host and path,
no rule, no edges and the default verdict. Repeated URLs are judged row by
row. Edges with an unusable target are ignored. Empty tables give empty
results; other columns pass through and give way to results of their name.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import packed, with_results
from loanscore.llm.components import connected_components

MAX_RULES = 1000
DEFAULT_VERDICT = "allow"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    pattern: str  # host/path

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "".join(self.pattern.partition("/")[1:])


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The URL without fragment, scheme and host in lower case; null without ``://``."""
    at = F.instr(url, "://")
    scheme = _lower(F.substr(url, F.lit(1), at + F.lit(2)))
    tail = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(at > 0, F.concat(scheme, host_of(url), tail))


def matched(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, action) of the winning rule, null fields if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.action == "allow")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) for each page with a canonical link or an immediate redirect in its HTML."""
    tagged = pages.where(F.col(html).rlike(r"""(?i)rel\s*=\s*["']?\s*canonical|http-equiv\s*=\s*["']?\s*refresh"""))
    canonical = F.regexp_extract(html, r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""", 1)
    refresh = F.regexp_extract(
        html, r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?url\s*=\s*([^"'\s>]+)""", 1
    )
    found = tagged.select(F.col(url).alias("src"), F.explode(F.array(canonical, refresh)).alias("link"))
    src, link = F.col("src"), F.replace(F.col("link"), F.lit("&amp;"), F.lit("&"))
    origin = F.regexp_extract("src", r"^[^:/?#]*://[^/?#]*", 0)
    folder = F.concat(origin, F.coalesce(F.nullif(F.regexp_extract(path_of(src), r"^.*/", 0), F.lit("")), F.lit("/")))
    target = (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.substring_index("src", "//", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(folder, link))
    )
    return found.where("link != ''").select("src", target.alias("dst"))


def judge_urls(urls: DataFrame, edges: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Every row of ``urls`` with host, path, rule, verdict and alias_verdict (null outside every component)."""
    links = edges.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    members = connected_components(links)
    action = matched(host_of(F.col("node")), path_of(F.col("node")), rules)["action"]
    spread = (
        members.df.groupBy("label")
        .agg(F.max(action == "allow").alias("allowed"), F.max(action == "block").alias("blocked"))
        .withColumn("alias_verdict", F.expr("CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END"))
    )
    aliases = members.df.join(spread, "label").select("node", "alias_verdict")
    judged = urls.select(
        packed(urls).alias("row"),
        F.coalesce(host_of(F.col(url)), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col(url)), F.lit("")).alias("path"),
        node_of(F.col(url)).alias("node"),
    ).withColumn("match", matched(F.col("host"), F.col("path"), rules))
    joined = judged.join(aliases, "node", "left")
    return with_results(
        joined,
        "row",
        {
            "host": F.col("host"),
            "path": F.col("path"),
            "rule": F.col("match.rule"),
            "verdict": F.coalesce("match.action", "alias_verdict", F.lit(DEFAULT_VERDICT)),
            "alias_verdict": F.col("alias_verdict"),
        },
    )
