"""Host verdicts for urls: rules first, propagated trust and distrust for the rest.

Hosts form a graph: hyperlinks between pages, and each subdomain with its
parent domain (down to two labels).  Personalised PageRank spreads trust along
links from hosts with pages that a rule allows, and distrust against links from
hosts with pages that a rule blocks.  A host is blocked when its distrust is
above the given share of both.  Ranks are whole numbers (parts of ``MASS``),
so sums do not depend on their order and results are the same on every run.

Rounds go on until the ranks' summed change is at most one in ``SETTLED`` of the
mass of a kind.  Each round keeps ``DAMPING_PERCENT`` of a difference, so that
happens within ``MOST_ROUNDS`` rounds on any graph; all that hosts further away
could still get together is of that order.

Everything is DataFrame operations.  Links are counted per page before the
shuffle by host pair; ranks are one row per host; pages are joined as the
preserved side, so adaptive execution can split a host with very many pages.
Each round's ranks are a written table.

Nulls and edge cases: a null url, or one without "://", has an empty host and
path, fits no rule, is no seed and is allowed.  A null html has no links.
Without seeds of a kind that kind's ranks are 0; a host that no rank reaches is
allowed.  Among rules that fit, the longest wins; of equally long ones the
first given.  Repeated pages count as often as they occur and give equal rows.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.scratch import Scratch


class Rule(NamedTuple):
    verdict: str
    rule: str  # host, then a path that begins with "/"


RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/"))

MASS = 10 ** 15
DAMPING_PERCENT, SETTLED = 85, 100
#: Both kinds' mass may move as a whole in the first round, out of one host into another.
MOST_ROUNDS = math.ceil(math.log(4 * SETTLED) / -math.log(DAMPING_PERCENT / 100)) + 1
#: A host is blocked above this share of distrust in its trust and distrust.
DISTRUST_PERCENT = 50

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The target of a hyperlink, in quotes or without, as far as a host can reach.
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]*)"""


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one; rules are part of the plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.rule)):
        name, slash, rest = r.rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        earlier = [x for x in rules if len(x.rule) == len(r.rule)]
        if earlier[0] != r:
            fits &= ~rule.isin([x.rule for x in earlier[:earlier.index(r)]]) | rule.isNull()
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict."""
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.withColumn("rule", rule).withColumn("ruled", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, and subdomains with their parents both ways."""
    found = pages.select(host_of(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("target"))
    # Relative targets stay on their host; "//host" inherits the scheme.
    target = F.when(F.col("target").startswith("//"), F.concat(F.lit("http:"), "target")).otherwise(F.col("target"))
    links = (found.select("src", host_of(target).alias("dst"))
             .filter("src != '' and dst != '' and src != dst")
             .groupBy("src", "dst").agg(F.count("*").alias("weight")))
    names = (pages.select(host_of(F.col("url")).alias("host")).distinct()
             .unionByName(links.select(F.col("dst").alias("host"))).filter("host != ''").distinct())
    # a.b.example.org: (a.b.example.org, b.example.org), (b.example.org, example.org)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size("labels") - 1),
                           lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    steps = (names.select(labels.alias("labels")).filter(F.size("labels") > 2)
             .select(suffixes.alias("s"))
             .select(F.explode(F.arrays_zip(F.expr("slice(s, 1, size(s) - 1)").alias("low"),
                                            F.expr("slice(s, 2, size(s) - 1)").alias("high"))).alias("p"))
             .select(F.col("p.low").alias("low"), F.col("p.high").alias("high")).distinct())
    kin = steps.select(F.col("low").alias("src"), F.col("high").alias("dst")).unionByName(
        steps.select(F.col("high").alias("src"), F.col("low").alias("dst"))).withColumn("weight", F.lit(1).cast("bigint"))
    return (links.unionByName(kin).groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def ranks(edges: DataFrame, seeds: DataFrame, scratch: Scratch) -> DataFrame:
    """(kind, host, mass) once settled; ``edges`` (kind, src, dst, weight) and
    ``seeds`` (kind, host, weight) hold a graph per kind."""
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    edges = scratch.settle(edges.join(out, ["kind", "src"]), "edges")
    whole = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = scratch.settle(
        seeds.join(whole, "kind")
        .select("kind", "host", F.expr(f"cast({MASS} as decimal(38)) * weight div total").alias("seed")), "seeds")
    jump = start.select("kind", "host", F.expr(f"seed * {100 - DAMPING_PERCENT} div 100").alias("mass"))
    current = start.select("kind", "host", F.col("seed").alias("mass"))
    for turn in range(MOST_ROUNDS):
        sent = (edges.join(current.withColumnRenamed("host", "src"), ["kind", "src"])
                .select("kind", F.col("dst").alias("host"),
                        F.expr(f"cast(mass as decimal(20)) * {DAMPING_PERCENT} * weight div (100 * total)").alias("mass")))
        following = scratch.settle(
            sent.unionByName(jump).groupBy("kind", "host").agg(F.sum("mass").alias("mass")), f"ranks{turn}")
        moved = (following.unionByName(current.withColumn("mass", -F.col("mass")))
                 .groupBy("kind", "host").agg(F.sum("mass").alias("by")).agg(F.sum(F.abs("by"))).first()[0] or 0)
        if turn:
            scratch.drop(f"ranks{turn - 1}")
        current = following
        if moved * SETTLED <= MASS:
            break
    return current


def verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    scratch = Scratch(pages.sparkSession, "url-trust")
    rows = judged(pages, rules)
    links = scratch.settle(host_edges(pages), "links")
    edges = links.withColumn("kind", F.lit("trust")).unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    seeds = (rows.filter("ruled is not null")
             .groupBy(F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
             .agg(F.count("*").alias("weight")))
    found = ranks(edges, seeds, scratch)
    by_host = found.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass")).otherwise(0)).alias("distrust"))
    trust, distrust = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    method = F.when(distrust * 100 > (trust + distrust) * DISTRUST_PERCENT, "block").otherwise("allow")
    return (rows.join(by_host, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"),
                    trust.cast("bigint").alias("trust"), distrust.cast("bigint").alias("distrust")))


def _sql_host(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}')"


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result in DuckDB SQL, every possible round written out."""
    ordered = sorted(rules, key=lambda r: -len(r.rule))

    def case(value) -> str:
        whens = []
        for r in ordered:
            name, slash, rest = r.rule.partition("/")
            whens.append(f"when (host = '{name}' or ends_with(host, '.{name}')) "
                         f"and starts_with(path, '{slash + rest}') then '{value(r)}'")
        return f"case {' '.join(whens)} end"

    href = HREF.replace("'", "''")
    rounds = ["r0 as (select kind, host, seed as mass from seeds)"]
    for i in range(MOST_ROUNDS):
        rounds.append(f"""r{i + 1} as (select kind, host, sum(mass)::hugeint as mass from (
            select e.kind, e.dst as host, (r.mass * {DAMPING_PERCENT} * e.weight) // (100 * e.total) as mass
            from edges e join r{i} r on e.kind = r.kind and e.src = r.host
            union all select kind, host, (seed * {100 - DAMPING_PERCENT}) // 100 from seeds) group by all)""")
    return f"""with p as materialized (select page_id, html, {_sql_host('url')} as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
    j as (select *, {case(lambda r: r.rule)} as rule, {case(lambda r: r.verdict)} as ruled from p),
    t as (select host as src, unnest(regexp_extract_all(html, '{href}', 1)) as target from p),
    l as (select * from (select src, {_sql_host("case when starts_with(target, '//') then 'http:' || target else target end")}
        as dst from t) where src <> '' and dst <> '' and src <> dst),
    n as (select string_split(host, '.') as b from (select host from p union select dst from l) where host <> ''),
    s as (select distinct array_to_string(b[i:], '.') as low, array_to_string(b[i + 1:], '.') as high
        from (select b, unnest(generate_series(1, len(b) - 2)) as i from n where len(b) > 2)),
    g as (select src, dst, count(*)::hugeint as weight from (select * from l union all select low, high from s
        union all select high, low from s) group by all),
    k as (select 'trust' as kind, src, dst, weight from g union all select 'distrust', dst, src, weight from g),
    edges as materialized (select *, sum(weight) over (partition by kind, src)::hugeint as total from k),
    w as (select case when ruled = 'allow' then 'trust' else 'distrust' end as kind, host, count(*)::hugeint as weight
        from j where ruled is not null group by all),
    seeds as materialized (select kind, host, ({MASS}::hugeint * weight) //
        (sum(weight) over (partition by kind))::hugeint as seed from w),
    {", ".join(x.replace(" as (", " as materialized (", 1) for x in rounds)},
    states as ({" union all ".join(f"select {i} as i, * from r{i}" for i in range(MOST_ROUNDS + 1))}),
    moved as (select i, sum(abs(d)) as change from (select i, kind, host, sum(mass) as d from (
        select * from states union all select i + 1, kind, host, -mass from states) where i > 0 and i <= {MOST_ROUNDS}
        group by i, kind, host) group by i),
    chosen as (select coalesce(min(i) filter (change * {SETTLED} <= {MASS}), {MOST_ROUNDS}) as i from moved),
    h as (select host, coalesce(sum(mass) filter (kind = 'trust'), 0) as trust,
        coalesce(sum(mass) filter (kind = 'distrust'), 0) as distrust
        from states where i = (select i from chosen) group by host)
    select page_id, j.host, path, rule, coalesce(ruled, case when coalesce(distrust, 0) * 100 >
        (coalesce(trust, 0) + coalesce(distrust, 0)) * {DISTRUST_PERCENT} then 'block' else 'allow' end) as verdict,
        coalesce(trust, 0)::bigint as trust, coalesce(distrust, 0)::bigint as distrust
    from j left join h on j.host = h.host"""
