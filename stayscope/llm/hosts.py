"""Host reputation by empirical Bayes, under explicit allow and block rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.session import cut_lineage

#: Fixed values: (verdict, rule). A rule is a host and a path prefix.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

#: Public suffixes of two labels; any other suffix is the last label.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn",
    "com.mx", "com.tr", "gov.uk", "net.au", "ne.jp", "or.jp", "org.au", "org.uk",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Standard deviations below the mean of the one-sided 95 % posterior bound.
Z = 1.645

#: A host is blocked if its share of bad pages is above this with that certainty.
BAD_SHARE = 0.5

#: Bounds of the intra-class correlation that the moments give for a level.
LEAST_RHO, MOST_RHO = 0.001, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty for a null url or one without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix, without user name and port.

    An IPv4 address is its own domain under the suffix ``ip``.
    """
    bare = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    suffix = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two)
    address = bare.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$")
    return F.when(address, bare).otherwise(domain), F.when(address, "ip").otherwise(suffix)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's.
    The rules are a stated list and become one expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _correlation(children: DataFrame, rate: str) -> float:
    """Beta-binomial correlation of a level by its moments around the parents' rates."""
    p, n, k = F.col(rate), F.col("n"), F.col("bad")
    spread = F.sum(n * F.pow(k / n - p, 2)) - F.sum(p * (1 - p))
    row = children.filter(n > 0).agg((spread / F.nullif(F.sum(p * (1 - p) * (n - 1)), F.lit(0.0))).alias("rho")).first()
    return min(MOST_RHO, max(LEAST_RHO, row.rho if row.rho is not None else LEAST_RHO))


def host_reputation(pages: DataFrame, outcomes: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Posterior share of bad pages per host.

    ``outcomes`` has ``page_id`` and ``bad`` (boolean); several outcomes of one
    page count as bad if any is. Each level (suffix, domain, host) is a
    beta-binomial draw around the posterior mean of the level above; how close it
    stays follows from the moments of all labelled pages of that level. Counts are
    summed per host first, so the largest host is one row afterwards. The suffix
    starts from the overall share (one bad and one good page are added to it).
    Returns ``host``, ``n``, ``bad``, ``mean`` and ``low``, the posterior bound.
    """
    host, _ = host_and_path(F.col(url))
    named = pages.select(F.col(page_id).alias("page_id"), host.alias("host"))
    labelled = outcomes.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    domain, suffix = registered_domain(F.col("host"))
    hosts = cut_lineage(
        named.join(labelled, "page_id", "left").groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total.bad or 0) + 1) / ((total.n or 0) + 2)

    def level(children: DataFrame, rate: str, name: str) -> DataFrame:
        strength = 1 / _correlation(children, rate) - 1
        return children.withColumn(name, (F.col("bad") + strength * F.col(rate)) / (F.col("n") + strength)).withColumn(
            f"{name}_strength", F.lit(strength)
        )

    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = level(hosts.groupBy("suffix").agg(*sums).withColumn("overall", F.lit(overall)), "overall", "of_suffix")
    domains = level(
        hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes.select("suffix", "of_suffix"), "suffix"),
        "of_suffix", "of_domain",
    )
    judged = level(
        hosts.join(domains.select("suffix", "domain", "of_domain"), ["suffix", "domain"]), "of_domain", "mean",
    )
    a = F.col("mean") * (F.col("n") + F.col("mean_strength"))
    size = F.col("n") + F.col("mean_strength")
    deviation = F.sqrt(a * (size - a) / (size * size * (size + 1)))
    return judged.select("host", "n", "bad", "mean", (F.col("mean") - Z * deviation).alias("low"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
    page_id: str = "page_id", url: str = "url", bad_share: float = BAD_SHARE,
) -> DataFrame:
    """Verdict per page: that of the longest fitting rule, else block if the
    posterior bound of its host is above ``bad_share``.

    Rows are kept as they come, repeated and null ones too (a null url has the
    empty host). Other columns are not read. Pages meet the host table in a
    shuffled join, where adaptive execution splits a host with many pages.
    """
    host, path = host_and_path(F.col(url))
    chosen = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    standing = cut_lineage(host_reputation(pages, outcomes, page_id, url))
    own = F.when(F.col("low") > bad_share, "block").otherwise("allow")
    return chosen.join(standing, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"),
        F.round("mean", 6).alias("bad_mean"), F.round("low", 6).alias("bad_low"),
    )
