"""URL filters by empirical-Bayes host reputation [native].

A page is blocked or allowed by the longest matching rule (host and path
prefix); the others by the reputation of their host. Labelled pages count
good and bad outcomes per host. A host with few of them says little, so its
rate is shrunk by a chain of beta-binomial priors: the corpus without the
host's suffix, the suffix without its domain, the domain without the host,
then the host's own outcomes, so every label counts once. How many labels a
prior is worth is learned at each level from how far the rates of its groups
scatter about their priors (method of moments); where no group has two
labels it is ``prior_strength``. A host is blocked if the ``confidence`` lower
bound of its posterior exceeds ``max_bad``, that is, if the regularised
incomplete beta function at ``max_bad``, worked out as a continued fraction,
is below 1 - ``confidence``; a host without labels is judged by its domain's
and suffix's.

Everything is DataFrame expressions. Outcome counts are pre-aggregated on
the map side; reputation is joined to pages by host, one row per host with
a label, and adaptive execution splits a host with a third of all pages.

Defined results: a null url or one without ``://`` has an empty host and
path, matches no rule and is judged by the corpus rate; a null label says
nothing; repeated rows are judged one by one; a page may have several
labels, each counts; an empty table gives an empty result, and without
labels the prior ``base_bad`` holds; further columns are carried along,
those named like a result column are replaced.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import ascii_lower, fresh_names, stored

# Labels before a country code under which domains are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gouv", "gov", "gv", "mil", "ne", "net", "nom", "or", "org")


@dataclass(frozen=True)
class Reputation:
    prior_strength: float = 20.0   # labels a prior is worth where the outcomes cannot tell
    weakest: float = 1.0           # bounds of what they can tell
    strongest: float = 10000.0
    confidence: float = 0.95       # one-sided
    max_bad: float = 0.25
    base_bad: float = 0.05         # rate assumed without any label
    second_level: tuple[str, ...] = SECOND_LEVEL
    suffixes: tuple[str, ...] = ()  # further suffixes of two labels, as of a list of public suffixes: "github.io"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    u = F.coalesce(url, F.lit(""))
    after = F.when(F.contains(u, F.lit("://")), F.regexp_extract(u, "(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.regexp_extract(after, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, "(?s)^[^/?#]*(/[^?#]*)", 1)
    return ascii_lower(host), path


def domain_parts(host: Column, model: Reputation | None = None) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host. The suffix is the last
    label, or the last two where a two-letter country code follows one of
    ``second_level`` or they are one of ``suffixes``; the domain has one label
    more."""
    model = model or Reputation()
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    labels = F.split(bare, "\\.")
    n = F.size(labels)
    last = lambda m: F.array_join(F.slice(labels, F.greatest(n - m + 1, F.lit(1)), F.least(F.lit(m), n)), ".")
    country = (F.char_length(F.element_at(labels, -1)) == 2) & F.get(labels, n - 2).isin(*model.second_level)
    two = (n >= 3) & (country | last(2).isin(*model.suffixes) if model.suffixes else country)
    return F.when(two, last(3)).otherwise(last(2)), F.when(two, last(2)).otherwise(last(1))


def _log_gamma(x: Column) -> Column:
    """Stirling's series, moved up by eight: to nine digits for x > 0."""
    y = x + 8
    low = x
    for k in range(1, 8):
        low = low * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(low)


def beta_below(x: float, good: Column, bad: Column) -> Column:
    """P(rate <= x) for a rate distributed Beta(bad, good): the regularised
    incomplete beta function by its continued fraction (Lentz), with terms
    enough for the size of the parameters."""
    upper = F.lit(x) >= (bad + 1) / (bad + good + 2)  # there the fraction of the other tail converges
    z = F.when(upper, 1 - x).otherwise(x)
    a, b = F.when(upper, good).otherwise(bad), F.when(upper, bad).otherwise(good)
    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(z) + b * F.log1p(-z)) / a
    off_zero = lambda v: F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

    def step(state: Column, m: Column) -> Column:
        even = m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))
        c1, d1 = off_zero(1 + even / state["c"]), 1 / off_zero(1 + even * state["d"])
        half = F.struct(c1.alias("c"), d1.alias("d"), (state["f"] * c1 * d1).alias("f"))

        def second(h: Column) -> Column:
            c2, d2 = off_zero(1 + odd / h["c"]), 1 / off_zero(1 + odd * h["d"])
            return F.struct(c2.alias("c"), d2.alias("d"), (h["f"] * c2 * d2).alias("f"))

        return F.element_at(F.transform(F.array(half), second), 1)

    d0 = 1 / off_zero(1 - (a + b) * z / (a + 1))
    first = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("f"))
    terms = F.transform(F.sequence(F.lit(1), (40 + 5 * F.sqrt(a + b)).cast("int")), lambda m: m.cast("double"))
    tail = F.least(front * F.aggregate(terms, first, step)["f"], F.lit(1.0))
    return F.when(upper, 1 - tail).otherwise(tail)


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null. A
    rule ``("block", "example.com/de/")`` fits its host and all subdomains
    where the path starts with the rule's."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        rule_host, slash, rule_path = rule.partition("/")
        on_host = (host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))
        fits.append(F.when(on_host & F.startswith(path, F.lit(slash + rule_path)),
                           F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _strength(groups: DataFrame, prior: Column, bad: Column, n: Column, model: Reputation) -> float:
    """How many labels the prior of a level is worth. For groups of n labels
    with rate p about their prior m, the sum of n (p - m)^2 is expected to be
    that of m (1 - m) (1 + (n - 1) rho), with rho = 1 / (strength + 1)."""
    m, k = F.col("m"), F.col("k")
    one = groups.select(prior.alias("m"), bad.alias("b"), n.alias("k")).filter(k > 0)
    scatter, noise, slope = one.agg(
        F.sum(F.pow(F.col("b") - k * m, F.lit(2)) / k), F.sum(m * (1 - m)), F.sum(m * (1 - m) * (k - 1))).first()
    if not slope:
        return model.prior_strength
    rho = (scatter - noise) / slope
    return model.strongest if rho <= 0 else min(max(1 / rho - 1, model.weakest), model.strongest)


def reputations(hosts: DataFrame, outcomes: DataFrame, model: Reputation) -> DataFrame:
    """(host, bad_mean, p_below) for every distinct ``host`` of ``hosts``,
    learned from ``outcomes`` (host, bad 0/1): the posterior mean, and the
    probability that the rate is at most ``max_bad``."""
    parts = dict(zip(("domain", "suffix"), domain_parts(F.col("host"), model)))
    seen = stored(outcomes.filter("bad is not null").groupBy("host").agg(
        F.sum(F.col("bad").cast("long")).alias("bad"), F.count("*").alias("n")).withColumns(parts), "url-hosts")
    sums = lambda of: [F.sum("bad").alias(f"bad_{of}"), F.sum("n").alias(f"n_{of}")]
    suffixes = seen.groupBy("suffix").agg(*sums("suffix"))
    domains = seen.groupBy("suffix", "domain").agg(*sums("domain"))
    known = hosts.select("host").distinct().withColumns(parts)
    known = known.join(suffixes, "suffix", "left").join(domains, ["suffix", "domain"], "left").join(seen.select("host", "bad", "n"), "host", "left")
    bad, n = seen.agg(F.sum("bad"), F.sum("n")).first()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))

    def shrunk(strength: float, prior: Column, inside: str, outside: str | None) -> tuple[Column, Column]:
        """Sum of bad labels and of labels: the prior's and a level's, without
        those of the level below."""
        less = lambda of: zero(f"{of}_{outside}") if outside else zero(of)
        b, k = (F.lit(bad or 0), F.lit(n or 0)) if inside == "corpus" else (zero(f"bad_{inside}"), zero(f"n_{inside}"))
        return strength * prior + b - less("bad"), F.lit(strength) + k - less("n")

    b0, n0 = shrunk(model.prior_strength, F.lit(model.base_bad), "corpus", "suffix")
    m0 = b0 / n0
    s1 = _strength(suffixes, m0, F.col("bad_suffix"), F.col("n_suffix"), model)
    b1, n1 = shrunk(s1, m0, "suffix", "domain")
    s2 = _strength(domains.join(suffixes, "suffix"), b1 / n1, F.col("bad_domain"), F.col("n_domain"), model)
    b2, n2 = shrunk(s2, b1 / n1, "domain", None)
    s3 = _strength(seen.join(domains, ["suffix", "domain"]).join(suffixes, "suffix"), b2 / n2, F.col("bad"), F.col("n"), model)
    alpha = s3 * (b2 / n2) + zero("bad")
    total = F.lit(s3) + zero("n")
    known = known.select("host", alpha.alias("alpha"), (total - alpha).alias("beta"))
    return known.select("host", (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("bad_mean"),
                        beta_below(model.max_bad, F.col("beta"), F.col("alpha")).alias("p_below"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    model: Reputation | None = None,
    url: str = "url",
) -> DataFrame:
    """The pages with host, path, rule, bad_mean, p_below (the
    probability that the host's rate is at most ``max_bad``) and verdict.
    ``outcomes`` has a ``url`` and ``bad`` (0/1) per labelled page."""
    model = model or Reputation()
    own = ("host", "path", "rule", "bad_mean", "p_below", "verdict")
    pages = pages.drop(*own)
    host, path = split_url(F.col(url))
    (match,) = fresh_names(pages, "_match")
    df = pages.withColumns({"host": host, "path": path})
    df = df.withColumn(match, match_rule(F.col("host"), F.col("path"), rules))
    known = reputations(df, outcomes.select(split_url(F.col("url"))[0].alias("host"), "bad"), model)
    known = stored(known, "url-reputations")
    df = df.join(known, "host").withColumn("rule", F.col(f"{match}.rule"))
    own_verdict = F.when(F.col("p_below") < 1 - model.confidence, "block").otherwise("allow")
    df = df.withColumn("verdict", F.coalesce(F.col(f"{match}.verdict"), own_verdict))
    return df.select(*pages.columns, *own)
