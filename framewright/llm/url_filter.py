"""URL filtering: stated rules first, then the reputation of the host by empirical Bayes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise, spread_join
from .empirical_bayes import STRENGTH, above, shrink

#: The stated rules, (verdict, host suffix, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Labels under which countries' registries give out names, as co in co.uk.
REGISTRY_LABELS = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "govt", "ltd", "me", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "sch")

#: A host is blocked when its bad rate exceeds MAX_BAD with at least the posterior probability CONFIDENCE.
MAX_BAD, CONFIDENCE = 0.3, 0.95
#: Steps of the continued fraction; beyond LARGE rows the posterior is taken as normal, which by then it is.
STEPS, LARGE, Z = 400, 50_000.0, 1.6448536269514722


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def site_of(host: Column) -> tuple[Column, Column, Column]:
    """Of a host, its site (without user and port), registered domain and public suffix.

    The suffix is the last label, or the last two where these are a label of REGISTRY_LABELS and one of two
    letters (co.uk); the domain has one label more. An address in numbers is its own domain and suffix.
    """
    site = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":[0-9]*$|\.+$", "")
    wide = site.rlike(rf"(^|\.)({'|'.join(REGISTRY_LABELS)})\.[a-z][a-z]$")
    number = site.rlike(r"^[0-9.]+$|^\[")
    suffix = F.when(number, site).when(wide, F.substring_index(site, ".", -2)).otherwise(F.substring_index(site, ".", -1))
    domain = F.when(number, site).when(wide, F.substring_index(site, ".", -3)).otherwise(F.substring_index(site, ".", -2))
    return site, domain, suffix


def _log_gamma(z: Column) -> Column:
    """Stirling's series, seven steps further on."""
    y, product = z + 7, z
    for i in range(1, 7):
        product = product * (z + i)
    series = (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return series - F.log(product)


def beta_share(a: Column, b: Column, x: float) -> Column:
    """The probability that a rate of the posterior Beta(a, b) is below `x`, by the continued fraction."""

    def part(a: Column, b: Column, x: Column) -> Column:
        def inside(v: Column) -> Column:  # no division by nothing
            return F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

        def state(c: Column, d: Column, h: Column) -> Column:
            return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

        def half(s: Column, t: Column) -> Column:
            d, c = 1 / inside(1 + t * s["d"]), inside(1 + t / s["c"])
            return state(c, d, s["h"] * d * c)

        def step(s: Column, m: Column) -> Column:
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return F.transform(F.array(half(s, even)), lambda t: half(t, odd))[0]

        d = 1 / inside(1 - (a + b) * x / (a + 1))
        first = state(F.lit(1.0), d, d)
        steps = F.transform(F.sequence(F.lit(1), F.lit(STEPS)), lambda m: m.cast("double"))
        h = F.aggregate(steps, first, step)["h"]
        front = a * F.log(x) + b * F.log(1 - x) + _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)
        return F.exp(front) * h / a

    low, high = part(a, b, F.lit(x)), 1 - part(b, a, F.lit(1 - x))
    return F.when(F.lit(x) < (a + 1) / (a + b + 2), low).otherwise(high)


def site_reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior bad rate of every site in `outcomes` (site, domain, suffix, bad 0/1 or null), written.

    Beta-binomial shrinkage goes from all pages to the suffix, from there to the registered domain and to the
    site. The columns are pages, n, bad, a, b, mean and `good`, the posterior probability that the rate is
    MAX_BAD at most. A site that has only nulls gets what is known of its domain, else of its suffix,
    else of all pages; without any label there are no rows. Counts are aggregated before each shuffle,
    so a site with a third of the pages costs one row a task; each level is written once.
    """
    site = materialise(outcomes.groupBy("site", "domain", "suffix").agg(
        F.count("*").alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "sites")
    domain = materialise(above(site, ["domain", "suffix"]), "domains")
    suffix = materialise(above(domain, ["suffix"]).withColumn("all", F.lit(1)), "suffixes")
    total = above(suffix, ["all"]).withColumn("mean", (F.col("bad") + 1) / (F.col("n") + 2)).where("n > 0")
    suffix = materialise(shrink(suffix, materialise(total, "all"), "all").drop("all", "a", "b", "k"), "suffix-posteriors")
    domain = materialise(shrink(domain, suffix, "suffix").drop("a", "b", "k"), "domain-posteriors")
    a, b = F.col("a"), F.col("b")
    bound = F.when(a + b < LARGE, beta_share(a, b, MAX_BAD)).otherwise(
        F.when(F.col("mean") - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > MAX_BAD, F.lit(0.0)).otherwise(1.0))
    return materialise(shrink(site, domain, "domain").withColumn("good", bound), "site-posteriors")


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules=RULES, url: str = "url", id_col: str = "page_id"
) -> DataFrame:
    """page id, host, path, rule, verdict for every row of `pages`.

    `rules` is a stated, short list; a rule fits its host and all subdomains if the path starts with its
    path, and the longest fitting rule wins. Elsewhere the verdict is ``block`` if the bad rate of the host's
    site is above MAX_BAD with a posterior probability of CONFIDENCE: the lower bound of the Beta posterior is
    above it. `outcomes` has (page id, bad): labelled pages.

    Nulls: a null url, or one without ``://``, has empty host and path, no rule, and the verdict of the
    empty host. A site without labelled pages is judged by its domain, suffix or all pages, by the same
    bound; without any label all are allowed. Outcomes with null id or null bad are left out; repeated
    ones each count, and so do pages that repeat an id. Very long urls are taken whole. Empty tables are fine;
    other columns are not looked at, whatever their names.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    site, domain, suffix = site_of(F.col("host"))
    rows = rows.withColumn("site", site)
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, ruled = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(ruled)
    known = outcomes.select(F.col(id_col).alias("page_id"), F.col("bad").cast("int").alias("bad")).where("bad is not null")
    labelled = rows.select("page_id", "host").join(known, "page_id").select("host", "bad")
    everything = labelled.unionByName(rows.select("host", F.lit(None).cast("int").alias("bad")))
    reputation = site_reputation(everything.select(site.alias("site"), domain.alias("domain"), suffix.alias("suffix"), "bad"))
    bad = reputation.where(F.col("good") < 1 - CONFIDENCE).select("site", F.lit("block").alias("bad"), "pages")
    return spread_join(rows, bad, ["site"], "pages", "left").select(
        F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(ruled, F.col("bad"), F.lit("allow")).alias("verdict"),
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Labelled outcomes of pages: the label with the page's number; bad is low quality or toxic."""
    return labels.select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad")
    )


def _sql_level(name: str, parent: str, up: str) -> str:
    return f"""
 {name}_m AS (SELECT c.*, p.mean AS m0 FROM {name} c JOIN {parent} p USING ("{up}")),
 {name}_q AS (SELECT sum(n * pow(bad / n::DOUBLE - m0, 2)) AS q, sum(m0 * (1 - m0)) AS e0, sum(n * m0 * (1 - m0)) AS e1 FROM {name}_m WHERE n > 0),
 {name}_k AS (SELECT CASE WHEN q > e0 THEN least(greatest((e1 - e0) / (q - e0) - 1, {STRENGTH[0]}), {STRENGTH[1]}) ELSE {STRENGTH[1]} END AS k FROM {name}_q),
 {name}_p AS (SELECT *, a / (a + b) AS mean FROM (SELECT m.*, m0 * k + bad AS a, (1 - m0) * k + n - bad AS b FROM {name}_m m, {name}_k))"""


#: The share of Beta(a, b) below MAX_BAD is summed over a fine grid here, not by the continued fraction.
OP7_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
 pg AS (
  SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$|\\.+$', '', 'g') AS site,
         CASE WHEN regexp_matches(site, '^[0-9.]+$|^\\[') THEN 99
              WHEN regexp_matches(site, '(^|\\.)({"|".join(REGISTRY_LABELS)})\\.[a-z][a-z]$') THEN 2 ELSE 1 END AS labels,
         array_to_string(string_split(site, '.')[-labels - 1:], '.') AS domain, array_to_string(string_split(site, '.')[-labels:], '.') AS suffix FROM u),
 h AS (
  SELECT site, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM pg LEFT JOIN (SELECT doc_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL AND toxic IS NOT NULL THEN 0 END AS bad FROM labels) ON page_id = doc_id
  GROUP BY ALL),
 d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
 s AS (SELECT suffix, 1 AS "all", sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
 t AS (SELECT "all", (sum(bad) + 1) / (sum(n) + 2)::DOUBLE AS mean FROM s GROUP BY "all" HAVING sum(n) > 0),
 {_sql_level("s", "t", "all")}, {_sql_level("d", "s_p", "suffix")}, {_sql_level("h", "d_p", "domain")},
 v AS (
  SELECT site FROM (SELECT DISTINCT site, a, b FROM h_p), (SELECT (i + 0.5::DOUBLE) / 4000 AS x FROM range(4000) g(i))
  GROUP BY site, a, b
  HAVING sum(CASE WHEN x < {MAX_BAD} THEN exp((a - 1) * ln(x) + (b - 1) * ln(1 - x) + lgamma(a + b) - lgamma(a) - lgamma(b)) / 4000 ELSE 0 END) < {1 - CONFIDENCE:.4f}),
 rules(verdict, rh, rp) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
 best AS (
  SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS ruled
  FROM (SELECT DISTINCT host, path FROM pg) JOIN rules ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp) JOIN pg USING (host, path)
  GROUP BY page_id, host, path)
SELECT pg.page_id, pg.host, pg.path, b.rule,
       coalesce(b.ruled, CASE WHEN v.site IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM pg LEFT JOIN best b ON b.page_id IS NOT DISTINCT FROM pg.page_id AND b.host = pg.host AND b.path = pg.path LEFT JOIN v ON v.site = pg.site
"""
