"""URL filter: explicit rules first, then empirical-Bayes host reputation.

Reputation shrinks the labelled outcomes of a host towards its registered
domain, the domain towards its suffix and the suffix towards the whole corpus.
Each level is beta-binomial; its concentration is fitted by the method of
moments to how far the rates of the children stray from their parents' rates.
A host is blocked if the lower bound of its posterior rate of bad pages exceeds
``max_bad``.  Everything is a DataFrame expression.

Reputation is a site's: user, port and a dot at the end are left off the host before outcomes are
counted, while the host of the result and of the rules is as the url has it.

A host without outcomes of its own has its registered domain's rate, as uncertain as hosts are about their domains; one of an
unknown domain the suffix's, as uncertain as domains are about suffixes; one of an unknown suffix the corpus's, as uncertain as suffixes are about that.

Defined results: a null url, or one without ``://``, has an empty host and path
and no rule, and is judged like the host of an unknown suffix; without any outcome there is no bound, and all that no rule
blocks is allowed.  Null outcomes are ignored.  Repeated rows count each time; an empty table of pages
gives an empty result.
Other columns of the input are dropped from the result, so their names can't
clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, stored

#: Labels that make a public suffix with any country code after them (a rule instead of a table).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Further public suffixes of two labels (fixed values; a parameter below).
LONG_SUFFIXES = (
    "asso.fr", "gouv.fr", "go.id", "or.id", "go.jp", "ne.jp", "or.jp", "go.kr", "ne.kr", "or.kr", "re.kr", "gob.ar", "gob.cl", "gob.es", "gob.mx", "gob.pe", "nom.br", "nom.es",
    "gv.at", "or.at", "go.th", "in.th", "or.th", "id.au", "govt.nz", "school.nz", "ltd.uk", "me.uk", "nhs.uk", "plc.uk", "police.uk", "sch.uk", "web.za", "nic.in", "res.in", "gen.in", "firm.in", "ind.in",
)


def url_host(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, at + F.lit(3))
    return F.when(at > 0, ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))).otherwise("")


def url_path(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.regexp_replace(F.substr(url, at + F.lit(3)), "^[^/?#]*", "")
    return F.when(at > 0, F.regexp_extract(rest, "^[^?#]*", 0)).otherwise("")


def host_suffix(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    """The public suffix: the last label, or two labels where the rule or the list says so."""
    two = F.substring_index(host, ".", -2)
    ruled = two.rlike(f"^({'|'.join(SECOND_LEVEL)})[.][a-z][a-z]$")
    return F.when(ruled | two.isin(*long_suffixes), two).otherwise(F.substring_index(host, ".", -1))


def site(host: Column) -> Column:
    """The host without user, port and a dot at its end."""
    return F.regexp_replace(F.regexp_replace(F.substring_index(host, "@", -1), ":[0-9]*$", ""), "[.]$", "")


def registered_domain(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it; the suffix alone if there is none."""
    label = F.substring_index(
        F.when(F.length(host) > F.length(suffix) + 1, F.substr(host, F.lit(1), F.length(host) - F.length(suffix) - 1)), ".", -1
    )
    return F.when(label.isNull(), suffix).otherwise(F.concat_ws(".", label, suffix))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, both null if none fits.

    A rule is ``host/path``; it fits that host and its subdomains where the
    path starts with the rule's.  Equally long rules: the first listed.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(reversed(list(rules)), key=lambda r: len(r[1])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _concentration(rates: DataFrame, name: str) -> DataFrame:
    """One row: the beta concentration fitted to (n, bad, parent) of all children."""
    p = F.col("parent")
    sums = rates.agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.col("n") * (F.col("bad") / F.col("n") - p) * (F.col("bad") / F.col("n") - p)).alias("spread"),
        F.sum(F.col("n") * p * (1 - p)).alias("noise"),
    )
    v = F.try_divide(F.col("noise"), F.col("total"))
    spare = F.col("total") - F.try_divide(F.col("squares"), F.col("total")) - (F.col("groups") - 1)
    rho = F.try_divide(F.col("spread") - v * (F.col("groups") - 1), v * spare)
    bounded = F.least(F.greatest(F.coalesce(rho, F.lit(0.01)), F.lit(0.001)), F.lit(0.5))
    return sums.select(((1 - bounded) / bounded).alias(name))


@dataclass(frozen=True)
class Reputation:
    """Posterior rates and their sizes (n + concentration), by level; ``corpus`` is one row.

    ``hosts`` has (host, rate, size), ``domains`` (domain, suffix, rate, size) and ``suffixes`` (suffix, rate, size) those of a host that
    the level below doesn't know.
    """

    hosts: DataFrame
    domains: DataFrame
    suffixes: DataFrame
    corpus: DataFrame


def host_reputation(outcomes: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Reputation:
    """The levels' posteriors from rows (host, bad 0/1).

    Hosts are summed before any shuffle, so a host with a third of the rows is
    one row per task; the sums are written once, and every level starts from them.
    """
    rows = outcomes.where(F.col("bad").isNotNull())
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    hosts = hosts.withColumn("suffix", host_suffix(F.col("host"), long_suffixes))
    hosts = stored(hosts.withColumn("domain", registered_domain(F.col("host"), F.col("suffix"))), "host-outcomes")
    domains = stored(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domain-outcomes")
    suffixes = stored(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffix-outcomes")
    whole = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2)).alias("parent"))

    def shrunk(level: DataFrame, parents: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
        above = level.join(parents, keys) if keys else level.join(F.broadcast(parents))  # without keys: one row
        strength = _concentration(above, "strength")  # one row
        mean = (F.col("bad") + F.col("strength") * F.col("parent")) / (F.col("n") + F.col("strength"))
        return above.join(F.broadcast(strength)).select(*level.columns, mean.alias("rate"), (F.col("n") + F.col("strength")).alias("size")), strength

    by_suffix, about_corpus = shrunk(suffixes, whole, [])
    by_domain, about_suffix = shrunk(domains, by_suffix.select("suffix", F.col("rate").alias("parent")), ["suffix"])
    by_host, about_domain = shrunk(hosts, by_domain.select("domain", "suffix", F.col("rate").alias("parent")), ["domain", "suffix"])
    told = suffixes.agg(F.count(F.lit(1)).alias("told"))  # without an outcome nothing is known, and no page is blocked
    corpus = whole.join(F.broadcast(about_corpus)).join(F.broadcast(told)).select(F.when(F.col("told") > 0, F.col("parent")).alias("rate"), F.col("strength").alias("size"))  # one row
    unseen = lambda level, about, *keys: level.join(F.broadcast(about)).select(*keys, "rate", F.col("strength").alias("size"))
    return Reputation(by_host.select("host", "rate", "size"), unseen(by_domain, about_domain, "domain", "suffix"), unseen(by_suffix, about_suffix, "suffix"), corpus)


def bounded(sites: DataFrame, known: Reputation, z: float, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """(site, bad_bound) of distinct sites: mean - z * standard deviation of the posterior of the lowest level that knows the site."""
    named = sites.select("site", host_suffix(F.col("site"), long_suffixes).alias("suffix"))
    named = named.withColumn("domain", registered_domain(F.col("site"), F.col("suffix")))
    level = lambda df, k: df.withColumnsRenamed({"rate": f"rate{k}", "size": f"size{k}"})
    found = named.join(level(known.hosts, 0).withColumnRenamed("host", "site"), "site", "left")
    found = found.join(level(known.domains, 1), ["domain", "suffix"], "left").join(level(known.suffixes, 2), "suffix", "left")
    found = found.join(F.broadcast(level(known.corpus, 3)))  # one row
    rate, size = (F.coalesce(*[F.col(f"{c}{k}") for k in range(4)]) for c in ("rate", "size"))
    return found.select("site", (rate - F.lit(z) * F.sqrt(rate * (1 - rate) / (size + 1))).alias("bad_bound"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    z: float = 1.645,
    max_bad: float = 0.2,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """(id, host, path, rule, verdict, bad_bound) for each row of ``pages``.

    ``outcomes`` has columns url and bad (0 or 1).  Reputations are looked up once for each site of the pages.
    """
    parsed = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    parsed = parsed.select(id_col, url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"))
    known = host_reputation(outcomes.select(site(url_host(F.col("url"))).alias("host"), F.col("bad")), long_suffixes)
    parsed = parsed.withColumn("_site", site(F.col("host")))
    bounds = bounded(parsed.select(F.col("_site").alias("site")).distinct(), known, z, long_suffixes)
    judged = parsed.join(bounds.withColumnRenamed("site", "_site"), "_site", "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_bound") > max_bad, F.lit("block")).otherwise("allow")
    return judged.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "bad_bound")
