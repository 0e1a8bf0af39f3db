"""URL filter by rules, and by the reputation of hosts where no rule fits.

A page's outcome is a label, good (1) or bad (0). Outcomes are counted by host, by
registered domain and by public suffix, and the share of good pages is shrunk down
this tree: all outcomes give the mean for suffixes, a suffix that for its domains, a
domain that for its hosts. How strongly a level is held to its parent is estimated
from the level itself: the spread of its children's shares beyond what counting alone
explains gives the correlation of a beta-binomial distribution, by moments. A host's
share is then beta distributed, and the host is blocked where even the upper bound of
that share stays below ``FLOOR``. A host that nobody labelled inherits its domain's
mean with the weight of the prior alone.

Everything is a DataFrame expression. Outcomes leave each task as one row for a host,
and the pages meet the blocked hosts in a left join whose two sides are scans, so that
adaptive execution can split a host that holds a third of all pages.

Defined cases: a null url, or one without ``://``, has an empty host and path, which
count as a host of their own. User names and ports belong to the host that rules see,
not to the one that has a reputation. A page without a label, or with a null id, is no
outcome but is judged; a repeated page counts each time; an id labelled more than once
is good if any label says so. Without any label all shares are one half. Of rules that
fit, the longest ``host + path`` wins, then the smaller text, then block before allow;
a rule without a host or with a null in it fits nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateloom.llm.storage import stored
from stateloom.sources.files import shared_dir

#: A host is blocked when its share of good pages is below this with the confidence of Z.
FLOOR = 0.5
#: Standard deviations between the mean of a host's share and its upper bound.
Z = 1.645
#: Range of the correlation within a level; its prior weighs as much as 1/rho - 1 outcomes.
RHO = (0.001, 0.5)
#: The rules of the registered query, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Second-level labels that are part of a suffix when a country's label of two letters follows.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, without upper case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def registered(host: Column) -> tuple[Column, Column, Column]:
    """The machine named by a host, its registered domain and its public suffix.

    An address of numbers and a name of one label are their own domain and suffix.
    """
    name = F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), ":[0-9]*$", "")
    labels = F.split(name, "\\.")
    n = F.size(labels)
    country = (n > 2) & (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, F.when(n > 1, -2).otherwise(-1)).isin(*SECOND_LEVEL)
    suffix_labels = F.when(country, 2).otherwise(1)
    alone = (n == 1) | name.rlike("^[0-9.]+$") | F.contains(name, F.lit("["))
    tail = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")
    return name, F.when(alone, name).otherwise(tail(suffix_labels + 1)), F.when(alone, name).otherwise(tail(suffix_labels))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The rule that fits best, as text, and its verdict; both null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    known = [r for r in rules if None not in r and r[1]]
    # The last condition that is put around the others is looked at first.
    for kind, rule_host, rule_path in sorted(set(known), key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0] != "block"), reverse=True):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _shrunk(level: DataFrame) -> DataFrame:
    """Rows with n, good and the parent's ``mean``: the level's prior weight, from its own spread, as ``weight``.

    Under a beta-binomial distribution of correlation rho, n * (share - mean)**2 is
    mean * (1 - mean) * (1 + (n - 1) * rho) on average; summed over the level, that is solved for rho.
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    over, room = (
        level.where("n > 0")
        .agg(F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("mean"), F.lit(2)) - spread), F.sum(spread * (F.col("n") - 1)))
        .first()
    )
    rho = min(max(over / room, RHO[0]), RHO[1]) if room else RHO[1]
    return level.withColumn("weight", F.lit(1 / rho - 1))


def _posterior() -> Column:
    """The mean of a share between its own outcomes and its parent's mean."""
    return (F.col("good") + F.col("weight") * F.col("mean")) / (F.col("n") + F.col("weight"))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, domain, suffix, n, good, share (posterior mean), upper (bound of the share) of every host of the pages.

    ``pages`` has page_id and url, ``outcomes`` page_id and good (0, 1 or null).
    """
    folder = shared_dir(pages.sparkSession)
    seen = pages.select("page_id", url_host(F.col("url")).alias("host"))
    known = outcomes.where("good in (0, 1) and page_id is not null").groupBy("page_id").agg(F.max("good").alias("good"))
    labelled = (
        seen.where("page_id is not null").groupBy("page_id", "host").agg(F.count("*").alias("n"))
        .join(known, "page_id")
        .select("host", "n", (F.col("n") * F.col("good")).alias("good"))
    )
    nothing = [F.lit(0).cast("long").alias(c) for c in ("n", "good")]
    name, domain, suffix = registered(F.col("host"))
    every = labelled.union(seen.select("host", *nothing)).select(
        name.alias("host"), domain.alias("domain"), suffix.alias("suffix"), "n", "good"
    )
    totals = [F.sum(c).alias(c) for c in ("n", "good")]
    hosts = stored(every.groupBy("host", "domain", "suffix").agg(*totals), folder, "hosts")
    domains = stored(hosts.groupBy("domain", "suffix").agg(*totals), folder, "domains")
    suffixes = stored(domains.groupBy("suffix").agg(*totals), folder, "suffixes")

    n, good = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    top = _shrunk(suffixes.withColumn("mean", F.lit((good + 1) / (n + 2))))
    top = stored(top.select("suffix", _posterior().alias("mean")), folder, "suffix_means")
    middle = _shrunk(domains.join(top, "suffix"))
    middle = stored(middle.select("domain", "suffix", _posterior().alias("mean")), folder, "domain_means")
    mass = F.col("n") + F.col("weight")
    return (
        _shrunk(hosts.join(middle, ["domain", "suffix"]))
        .withColumn("share", _posterior())
        .withColumn("upper", F.col("share") + Z * F.sqrt(F.col("share") * (1 - F.col("share")) / (mass + 1)))
        .select("host", "domain", "suffix", "n", "good", "share", "upper")
    )


def judged(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of every page."""
    folder = shared_dir(pages.sparkSession)
    bad = host_reputation(pages, outcomes).where(F.col("upper") < FLOOR)
    bad = stored(bad.select(F.col("host").alias("machine"), F.lit(True).alias("blocked")), folder, "blocked")
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"machine": registered(F.col("host"))[0], "rule": rule, "by_rule": verdict})
    by_host = F.when(F.col("blocked"), "block").otherwise("allow")
    return rows.join(bad, "machine", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict")
    )


def contract(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """All pages; a page's outcome is the quality label of its id."""
    return judged(pages, labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good")))


def _oracle() -> str:
    extract = "regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', {}, 's')"
    rules = ", ".join(f"('{kind}', '{host}', '{path}')" for kind, host, path in RULES)
    second = ", ".join(f"'{x}'" for x in SECOND_LEVEL)

    def weight(level: str) -> str:
        return f"""(SELECT CASE WHEN coalesce(room, 0) = 0 THEN 1 / {RHO[1]} - 1
                ELSE 1 / least(greatest(above / room, {RHO[0]}), {RHO[1]}) - 1 END
            FROM (SELECT sum(n * pow(good / n - mean, 2) - mean * (1 - mean)) AS above,
                         sum(mean * (1 - mean) * (n - 1)) AS room FROM {level} WHERE n > 0))"""

    return f"""
    WITH rules(kind, rule_host, rule_path) AS (VALUES {rules}),
    parts AS (
        SELECT page_id, url, row_number() OVER () AS line,
               translate(coalesce({extract.format(1)}, ''), '{_UPPER}', '{_LOWER}') AS host,
               coalesce({extract.format(2)}, '') AS path
        FROM pages),
    names AS (
        SELECT *, regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*$', '') AS machine FROM parts),
    cut AS (
        SELECT *, string_split(machine, '.') AS l FROM names),
    sized AS (
        SELECT *, CASE WHEN len(l) > 2 AND length(l[-1]) = 2 AND l[-2] IN ({second}) THEN 2 ELSE 1 END AS k,
               len(l) = 1 OR regexp_full_match(machine, '[0-9.]+') OR contains(machine, '[') AS alone
        FROM cut),
    tree AS (
        SELECT page_id, line, machine,
               CASE WHEN alone THEN machine ELSE array_to_string(l[greatest(len(l) - k, 1):], '.') END AS domain,
               CASE WHEN alone THEN machine ELSE array_to_string(l[greatest(len(l) - k + 1, 1):], '.') END AS suffix
        FROM sized),
    known AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
    hosts AS (
        SELECT machine, domain, suffix, count(known.good)::DOUBLE AS n, coalesce(sum(known.good), 0)::DOUBLE AS good
        FROM tree LEFT JOIN known ON tree.page_id = known.doc_id GROUP BY ALL),
    domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL),
    suffixes AS (
        SELECT suffix, sum(n) AS n, sum(good) AS good,
               (SELECT (sum(good) + 1) / (sum(n) + 2) FROM domains) AS mean FROM domains GROUP BY ALL),
    suffix_means AS (SELECT suffix, (good + w * mean) / (n + w) AS mean FROM suffixes, (SELECT {weight('suffixes')} AS w)),
    domains_under AS (SELECT d.*, s.mean FROM domains d JOIN suffix_means s USING (suffix)),
    domain_means AS (
        SELECT domain, suffix, (good + w * mean) / (n + w) AS mean
        FROM domains_under, (SELECT {weight('domains_under')} AS w)),
    hosts_under AS (SELECT h.*, d.mean FROM hosts h JOIN domain_means d USING (domain, suffix)),
    shares AS (
        SELECT machine, n + w AS mass, (good + w * mean) / (n + w) AS share
        FROM hosts_under, (SELECT {weight('hosts_under')} AS w)),
    blocked AS (
        SELECT machine FROM shares WHERE share + {Z} * sqrt(share * (1 - share) / (mass + 1)) < {FLOOR}),
    fitting AS (
        SELECT line, rule_host || rule_path AS rule, kind,
               row_number() OVER (PARTITION BY line ORDER BY length(rule_host || rule_path) DESC) AS place
        FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT p.page_id, p.host, p.path, f.rule,
           coalesce(f.kind, CASE WHEN b.machine IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM names p LEFT JOIN fitting f ON p.line = f.line AND f.place = 1 LEFT JOIN blocked b ON p.machine = b.machine
    """


ORACLE = _oracle()
