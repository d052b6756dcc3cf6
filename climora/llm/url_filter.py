"""Urls judged by written rules, and else by an empirical-Bayes reputation of their host.

Labelled pages are bad or good. The bad share of a host is drawn to that of its registered domain, that to its
suffix's, and that to the share among all pages: each level is a beta-binomial whose mean is the level above
and whose strength is estimated, by moments, from how far the units of the level scatter beyond what
chance explains. A host is blocked where the lower bound of its posterior is over the limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.llm.storage import stored

# Rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LIMIT = 0.25
# Words of hosts whose pages are labelled as bad.
BAD_WORDS = ("ads", "bets", "casino", "pills")
Z = 1.645
_STRENGTH = (1.0, 1e6)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url_col: str):
    """Host and path columns of a url; both empty for null and for urls without ``://``."""
    at = F.instr(url_col, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_columns(host, path, rules: Sequence[tuple[str, str, str]] = RULES):
    """The longest rule that fits, as text, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for judged, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(judged)).otherwise(verdict)
    return name, verdict


def _level(units: DataFrame, unit: str, above: DataFrame, parent: str) -> DataFrame:
    """Posterior mean of each unit (columns unit, parent, n, k) from the posterior means of the level above."""
    joined = units.join(above.select(F.col("unit").alias("parent"), F.col("mean").alias("prior")), "parent")
    sums = stored(joined, f"reputation-{unit}")
    share = F.col("k") / F.col("n")
    spread = sums.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (share - F.col("prior")) * (share - F.col("prior"))).alias("q"),
        F.sum(F.col("prior") * (F.lit(1.0) - F.col("prior"))).alias("w"),
        F.sum(F.col("n") * F.col("prior") * (F.lit(1.0) - F.col("prior"))).alias("v"),
    ).first()
    strength = _STRENGTH[1]
    if spread.n and spread.q > spread.w:
        strength = min(max(spread.v / (spread.q - spread.w) - 1, _STRENGTH[0]), _STRENGTH[1])
    return sums.withColumn("strength", F.lit(float(strength))).withColumn(
        "mean", (F.col("k") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength"))
    )


def _levels(outcomes: DataFrame, host_col: str, bad_col: str) -> list[DataFrame]:
    """Posterior means of hosts, registered domains, suffixes and of everything, in this order."""
    hosts = outcomes.where(F.col(bad_col).isNotNull()).groupBy(F.col(host_col).alias("unit")).agg(
        F.count("*").alias("n"), F.sum(F.col(bad_col).cast("long")).alias("k")
    )
    hosts = stored(hosts.withColumn("parent", F.substring_index("unit", ".", -2)), "reputation-hosts")
    domains = hosts.groupBy(F.col("parent").alias("unit")).agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn(
        "parent", F.substring_index("unit", ".", -1)
    )
    suffixes = domains.groupBy(F.col("parent").alias("unit")).agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("parent", F.lit(""))
    everything = suffixes.groupBy(F.col("parent").alias("unit")).agg((F.sum("k") / F.sum("n")).alias("mean"))
    by_suffix = _level(suffixes, "suffix", everything, "")
    by_domain = _level(domains, "domain", by_suffix, "")
    return [_level(hosts, "host", by_domain, ""), by_domain, by_suffix, everything]


def _low(mean, n, strength, z: float):
    """Lower bound of a posterior."""
    return mean - F.lit(z) * F.sqrt(mean * (F.lit(1.0) - mean) / (n + strength + F.lit(1.0)))


def reputations(outcomes: DataFrame, host_col: str = "host", bad_col: str = "bad", z: float = Z) -> DataFrame:
    """One row per host with labelled pages: unit (the host), n, k, mean and low, the lower posterior bound of its bad share.

    Null labels are left out. The registered domain of a host is its last two parts, the suffix its last.
    """
    judged = _levels(outcomes, host_col, bad_col)[0]
    return judged.select("unit", "n", "k", "mean", _low(F.col("mean"), F.col("n"), F.col("strength"), z).alias("low"))


def _blocked(hosts: DataFrame, outcomes: DataFrame, limit: float, z: float) -> DataFrame:
    """The distinct ``hosts`` (column host) over the limit. One without labelled pages has n = 0, and the mean of the level above that has any."""
    by_host, by_domain, by_suffix, everything = _levels(outcomes, "host", "bad")
    top = everything.first()  # one row, or none without labels
    if top is None:
        return hosts.select(F.col("host").alias("_climora_host")).limit(0)
    # one number each; a host scatters as widely as the widest of the levels between it and the one it gets its mean from
    s1, s2, s3 = (float(x.select("strength").first()[0]) for x in (by_host, by_domain, by_suffix))
    named = hosts.where(F.col("host").isNotNull()).distinct().withColumns(
        {"domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)}
    )
    found = (
        named.join(by_host.select(F.col("unit").alias("host"), "n", F.col("mean").alias("m1")), "host", "left")
        .join(by_domain.select(F.col("unit").alias("domain"), F.col("mean").alias("m2")), "domain", "left")
        .join(by_suffix.select(F.col("unit").alias("suffix"), F.col("mean").alias("m3")), "suffix", "left")
    )
    strength = F.when(F.coalesce("m1", "m2").isNotNull(), s1).when(F.col("m3").isNotNull(), min(s1, s2)).otherwise(min(s1, s2, s3))
    low = _low(F.coalesce("m1", "m2", "m3", F.lit(float(top.mean))), F.coalesce("n", F.lit(0)), strength, z)
    return found.where(low > F.lit(limit)).select(F.col("host").alias("_climora_host"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES, limit: float = LIMIT, z: float = Z,
) -> DataFrame:
    """One row per page: ``id_col``, host, path, rule (null where none fits) and verdict.

    ``outcomes`` has host and bad. A host without labelled pages is judged by its registered domain, else by its
    suffix, else by all pages. Null urls and urls without
    ``://`` have the empty host. Repeated rows give repeated results; an empty table gives none.
    """
    host, path = host_and_path(url_col)
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumns({"rule": name, "_climora_verdict": verdict})
    blocked = stored(_blocked(parsed.select("host"), outcomes, limit, z), "reputation-blocked")
    joined = parsed.join(blocked, F.col("host") == F.col("_climora_host"), "left")
    return joined.select(
        id_col, "host", "path", "rule",
        F.coalesce("_climora_verdict", F.when(F.col("_climora_host").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )


def marked_as_bad(text_col: str, marks: int = 10):
    """A label from the page itself: ``marks`` or more words end in a run of three equal symbols; null for null."""
    return F.regexp_count(text_col, F.lit(r"(###|\*\*\*|\$\$\$|%%%|&&&)")) >= marks


def _named_as_bad() -> str:
    """Pattern of hosts one of whose words is in ``BAD_WORDS``."""
    return f"(^|[.-])({'|'.join(BAD_WORDS)})([.-]|$)"


def outcomes_of_pages(pages: DataFrame, url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Columns host and bad, a row per page: marked by its text, or by a word in its host's name; null for pages without text."""
    host, _ = host_and_path(url_col)
    return pages.select(host.alias("host"), F.col(text_col).alias("_climora_text")).select(
        "host", (marked_as_bad("_climora_text") | F.when(F.col("_climora_text").isNotNull(), F.col("host").rlike(_named_as_bad()))).alias("bad")
    )


def _domain(host: str) -> str:
    return f"array_to_string(list_slice(string_split({host}, '.'), -2, -1), '.')"


def judge_sql(rules: Sequence[tuple[str, str, str]] = RULES, limit: float = LIMIT, z: float = Z, marks: int = 10) -> str:
    """DuckDB SQL for ``judge_urls`` over the table ``pages``, labelled by ``outcomes_of_pages``."""
    best = sorted(rules, key=lambda r: (len(r[1] + r[2]), r), reverse=True)
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in best]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, best))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, best))

    def level(name: str, units: str, above: str) -> str:
        return f"""
        {name}_j AS (SELECT u.unit, u.parent, u.n, u.k, a.mean AS prior FROM {units} u JOIN {above} a ON u.parent = a.unit),
        {name}_s AS (SELECT sum(n * (k / n - prior) * (k / n - prior)) AS q, sum(prior * (1 - prior)) AS w,
                            sum(n * prior * (1 - prior)) AS v FROM {name}_j),
        {name} AS (SELECT j.*, s.strength, (k + strength * prior) / (n + strength) AS mean FROM {name}_j j,
                   (SELECT CASE WHEN q > w THEN least(greatest(v / (q - w) - 1, {_STRENGTH[0]}::DOUBLE), {_STRENGTH[1]}::DOUBLE)
                                ELSE {_STRENGTH[1]}::DOUBLE END AS strength FROM {name}_s) s)"""

    return f"""
    WITH cut AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parsed AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    hosts AS (SELECT host AS unit, {_domain('host')} AS parent, count(*) AS n,
                     sum(CASE WHEN len(regexp_extract_all(html, '(###|\\*\\*\\*|\\$\\$\\$|%%%|&&&)')) >= {marks}
                                    OR regexp_matches(host, '{_named_as_bad()}') THEN 1 ELSE 0 END) AS k
              FROM parsed WHERE html IS NOT NULL GROUP BY host),
    domains AS (SELECT parent AS unit, list_last(string_split(parent, '.')) AS parent, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY hosts.parent),
    suffixes AS (SELECT parent AS unit, '' AS parent, sum(n) AS n, sum(k) AS k FROM domains GROUP BY domains.parent),
    everything AS (SELECT '' AS unit, sum(k) / sum(n) AS mean FROM suffixes),
    {level("l1", "suffixes", "everything")}, {level("l2", "domains", "l1")}, {level("l3", "hosts", "l2")},
    widths AS (SELECT (SELECT any_value(strength) FROM l3) AS s1, (SELECT any_value(strength) FROM l2) AS s2,
                      (SELECT any_value(strength) FROM l1) AS s3, (SELECT mean FROM everything) AS m0),
    found AS (SELECT h.host AS unit, coalesce(l3.n, 0) AS n, coalesce(l3.mean, l2.mean, l1.mean, m0) AS mean,
                     CASE WHEN coalesce(l3.mean, l2.mean) IS NOT NULL THEN s1 WHEN l1.mean IS NOT NULL THEN least(s1, s2)
                          ELSE least(s1, s2, s3) END AS strength
              FROM (SELECT DISTINCT host, {_domain('host')} AS domain, list_last(string_split(host, '.')) AS suffix FROM parsed) h
              LEFT JOIN l3 ON l3.unit = h.host LEFT JOIN l2 ON l2.unit = h.domain LEFT JOIN l1 ON l1.unit = h.suffix, widths),
    blocked AS (SELECT unit FROM found WHERE mean - {z!r}::DOUBLE * sqrt(mean * (1 - mean) / (n + strength + 1)) > {limit!r}::DOUBLE)
    SELECT page_id, host, path, CASE {rule} END AS rule,
           coalesce(CASE {verdict} END, CASE WHEN b.unit IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
    FROM parsed LEFT JOIN blocked b ON host = b.unit
    """
