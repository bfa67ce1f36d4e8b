"""URL rules with redirect equivalence (operator 6). DataFrame functions only.

A rule (host, path prefix, allow or block) fits its host, all subdomains and every path that starts with
its path; the longest fitting rule decides. Pages without a fitting rule take the decision of their
aliases: redirects (meta refresh) and canonical links of the page's HTML are edges between addresses,
addresses that one chain of edges joins are one component, and a component that holds a blocked page
blocks its other pages, unless it also holds a page that a rule allows. Without either: allow.
Targets of edges count whether they are rows or not: rules judge their addresses too.

Longest: by the length of host plus path, then of the host. Both are checked by exact lookups
(host suffixes), so any number of rules is one broadcast-size-checked join by Spark, not a scan of the rules.

Scale: pages are parsed once and written without HTML; components run on the edges only; addresses are
compared by 128-bit digests, and verdicts of a component are a map-side combined aggregate, so a hub
that a third of all pages point to is one row per task. Each distinct target is judged once.

Defined cases: null url or no '://': host and path are '', no rule fits, only its own HTML can link it;
null or empty html has no edges; a target is decoded ('&amp;', numeric and the other XML entities) and resolved against
the page's url as RFC 3986 does (dot segments only in relative targets; a page without host resolves none); targets
of other schemes without '//' (mailto:, javascript:) have no address; repeated rows get the same verdict; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.llm.common import stored, table
from quantlake.llm.components import connected_components

#: (host, path prefix, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

SALT = 32


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    # anchored behind the first '://', as a query may hold another
    rest = F.get(F.split(url, "://", 2), F.lit(1))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What two spellings of one address share: host, path and query, without scheme and fragment."""
    return F.concat(url_host(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1))


def decoded(text: Column) -> Column:
    """Numeric and XML character references replaced, each once."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)(&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&(?:amp|lt|gt|quot|apos);|&|[^&]+)"), F.lit(0))

    def one(p: Column) -> Column:
        named = F.when(p == "&amp;", "&").when(p == "&lt;", "<").when(p == "&gt;", ">").when(p == "&quot;", '"').when(p == "&apos;", "'")
        digits = F.when(p.rlike("^&#[0-9]+;$"), F.regexp_extract(p, "([0-9]+)", 1).cast("int")).when(
            p.rlike("^&#[xX][0-9a-fA-F]+;$"), F.conv(F.regexp_extract(p, "^&#[xX]([0-9a-fA-F]+);", 1), 16, 10).cast("int"))
        # a code point as four bytes of UTF-32
        char = F.when(digits.between(1, 0xD7FF) | digits.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32"))
        return F.coalesce(named, char, p)

    return F.when(text.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """``path`` (from '/') without '.' and '..' segments; one that ends in such a segment ends in '/'."""
    parts = F.slice(F.split(path, "/", -1), 2, 1 << 30)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(p == ".", done)
                       .when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p))))
    end = F.when(path.rlike(r"/\.{1,2}$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))


def resolved(target: Column, url: Column) -> Column:
    """The absolute form of a link target on the page ``url``; null if it has none."""
    host, page = url_host(url), F.concat(F.lit("http://"), url_host(url))
    path = F.when(url_path(url) == "", "/").otherwise(url_path(url))
    ref, query = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    asked = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    full = (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (target == "") | (host == ""), F.lit(None).cast("string"))
            .when(target.startswith("/"), F.concat(page, F.when(ref.rlike(r"/\.{1,2}(/|$)"), without_dots(ref)).otherwise(ref), query))
            .when(target.startswith("?"), F.concat(page, url_path(url), target))
            .when(target.startswith("#"), F.concat(page, url_path(url), asked, target))
            .otherwise(F.concat(page, without_dots(F.concat(F.regexp_extract(path, r"(?s)^(.*/)", 1), ref)), query)))
    return F.when(F.coalesce(url.contains("://"), F.lit(False)) | target.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:)?//"), full)


def linked_addresses(url: Column, html: Column) -> Column:
    """Targets of canonical links and meta refreshes, as an array of addresses."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    wanted = F.filter(tags, lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b|\bhttp-equiv\s*=\s*["']?refresh\b"""))
    target = F.transform(wanted, lambda t: decoded(F.trim(F.regexp_extract(
        t, r"""(?is)(?:\bhref\s*=\s*["']?|\burl\s*=\s*["']?)([^"'>\s]+)""", 1))))
    full = F.transform(target, lambda t: resolved(t, url))
    return F.transform(F.filter(full, lambda t: t.isNotNull()), address)


def rule_table(spark: SparkSession, rules) -> DataFrame:
    rows = [(h.lower(), p, v, f"{h}{p}") for h, p, v in rules]
    return spark.createDataFrame(rows, "rule_host string, rule_path string, rule_verdict string, rule string").dropDuplicates(["rule"])


def rule_hits(parsed: DataFrame, rules: DataFrame) -> DataFrame:
    """``parsed`` (host, path, ...) with ``rule`` and ``rule_verdict`` of the longest rule, or null.

    Hosts repeat, so the rules are met per distinct host; a host fits its own dot-separated suffixes only.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = parsed.select("host").distinct().select("host", F.explode(suffixes).alias("rule_host"))
    known = hosts.join(rules, "rule_host").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct(
            (-F.length("rule")).alias("n"), (-F.length("rule_host")).alias("h"), "rule_path", "rule", "rule_verdict"))).alias("fits"))
    # the rules that fit one host are bounded by the rules, not by the pages
    best = F.get(F.filter("fits", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    # a host may hold a third of all pages, so it is met in SALT places
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    met = parsed.withColumn("salt", F.pmod(F.hash("path", "node"), F.lit(SALT))).join(known, ["host", "salt"], "left").drop("salt")
    return met.withColumn("best", best).withColumn("rule", F.col("best.rule")).withColumn(
        "rule_verdict", F.col("best.rule_verdict")).drop("fits", "best")


def judge(pages: DataFrame, rules, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, aliases_blocked, aliases_allowed for every row of ``pages``."""
    url, html = F.col(url_col), F.coalesce(F.col(html_col), F.lit(""))
    has = F.coalesce(url.contains("://"), F.lit(False))
    node = F.md5(F.when(has, F.concat(F.lit("u"), address(url))).otherwise(F.concat(F.lit("n"), F.coalesce(url, F.col(id_col).cast("string"), F.lit("")))))
    parsed = stored(pages.select(
        F.col(id_col).alias("page_id"),
        F.when(has, url_host(url)).otherwise("").alias("host"),
        F.when(has, url_path(url)).otherwise("").alias("path"),
        node.alias("node"),
        linked_addresses(url, html).alias("links"),
    ), "pages")
    links = parsed.select(F.col("node").alias("a"), F.explode("links").alias("to")).withColumn("b", F.md5(F.concat(F.lit("u"), F.col("to"))))
    edges = links.select("a", "b")
    comps = connected_components(edges)
    rules = rule_table(pages.sparkSession, rules)
    named = lambda df: df.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ruled = named(rule_hits(parsed.drop("links"), rules))
    # an address begins with its host, so both parts are read behind a '://'
    to = F.concat(F.lit("http://"), F.col("to"))
    targets = links.select(F.col("b").alias("node"), "to").distinct().select("node", url_host(to).alias("host"), url_path(to).alias("path"))
    heard = named(rule_hits(targets, rules)).select("component", "rule", "rule_verdict")
    # only components that a rule reaches are kept, so the join back is small
    says = ruled.select("component", "rule", "rule_verdict").unionByName(heard).where(F.col("rule").isNotNull()).groupBy("component").agg(
        F.max(F.col("rule_verdict") == "block").alias("aliases_blocked"), F.max(F.col("rule_verdict") == "allow").alias("aliases_allowed"))
    blocked, allowed = (F.coalesce(c, F.lit(False)) for c in ("aliases_blocked", "aliases_allowed"))
    verdict = F.coalesce("rule_verdict", F.when(blocked & ~allowed, "block").otherwise("allow"))
    return ruled.join(says, "component", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), blocked.alias("aliases_blocked"), allowed.alias("aliases_allowed"))


def op6_url_filters(spark, sf_dir):
    """Every page's verdict under RULES and its redirect equivalences."""
    return judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


_FIT = " UNION ALL ".join(
    f"SELECT '{h}' AS rh, '{p}' AS rp, '{v}' AS rv, '{h}{p}' AS rule" for h, p, v in RULES)

ORACLE_SQL = rf"""
WITH RECURSIVE p AS (
  SELECT page_id, url,
    CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*(/[^?#]*)', 1) ELSE '' END AS path,
    CASE WHEN url LIKE '%://%' THEN 'u' || translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') ELSE 'n' || coalesce(url, page_id::VARCHAR, '') END AS node,
    list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\b[^>]*>'),
      lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b|\bhttp-equiv\s*=\s*["'']?refresh\b')) AS tags
  FROM pages),
l AS (SELECT node, host, regexp_extract(unnest(tags), '(?is)(?:\bhref\s*=\s*["'']?|\burl\s*=\s*["'']?)([^"''>\s]+)', 1) AS t FROM p),
f AS (SELECT node, CASE WHEN t LIKE '%://%' THEN t WHEN t LIKE '//%' THEN 'http:' || t WHEN t LIKE '/%' AND host <> '' THEN 'http://' || host || t END AS t FROM l),
e AS (SELECT node AS a, 'u' || translate(regexp_extract(t, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || regexp_extract(t, '^.*?://[^/?#]*([^#]*)', 1, 's') AS b FROM f WHERE t IS NOT NULL),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT DISTINCT a AS node, a AS other FROM s UNION SELECT r.node, s.b FROM reach r JOIN s ON r.other = s.a),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY 1),
rules AS ({_FIT}),
hit AS (SELECT p.page_id, p.host, p.path, p.node, r.rule, r.rv,
          row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST, length(r.rh) DESC) AS n
        FROM p LEFT JOIN rules r ON (p.host = r.rh OR p.host LIKE '%.' || r.rh) AND starts_with(p.path, r.rp)),
c AS (SELECT h.*, coalesce(comp.component, h.node) AS component FROM hit h LEFT JOIN comp ON comp.node = h.node WHERE n = 1),
says AS (SELECT component, bool_or(rv = 'block') AS bl, bool_or(rv = 'allow') AS al FROM c WHERE rule IS NOT NULL GROUP BY 1)
SELECT page_id, host, path, rule,
       coalesce(rv, CASE WHEN coalesce(bl, false) AND NOT coalesce(al, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN says USING (component)
"""
