from urllib.parse import urlsplit

import pytest

from paylens.llm import url_trust as trust
from paylens.llm.scratch import Scratch


def page(i, url, *links):
    return (i, url, "".join(f'<p><a class="x" href="{h}">t</a>' for h in links), "x")


ROWS = [
    page(1, "http://A.Example.org/es/x?q", "http://bad.net/1", "/local", "//cdn.net/x"),
    page(2, "https://org/"), page(3, "https://org"), page(4, "http://example.org/en/12#f"),
    page(5, "http://notexample.org/es/1"), page(6, "ftp://u@x.com:8/fr/é?/de/"), page(7, "http://x.com/de/1"),
    page(8, None, "http://bad.net/"), page(9, "no scheme/com/de/"), page(10, ""), page(11, "http://bad.net/a", "HTTP://x.com/y"),
    page(12, "http://friend.net/a"), page(13, "http://x.com/fr/2", "http://friend.net/", "http://friend.net/2"),
    page(13, "http://x.com/fr/2", "http://friend.net/", "http://friend.net/2"), (14, "http://friend.net/q", None, "x"),
    page(None, "http://spam.net/", "http://x.com/de/9"), page(15, "x://y://z.com/fr/"), page(16, "http://a.b\n.com/de/"),
]
SCHEMA = "page_id bigint, url string, html string, host string"


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [r.rule for r in trust.RULES
           if (host == r.rule.split("/")[0] or host.endswith("." + r.rule.split("/")[0]))
           and path.startswith("/" + r.rule.split("/", 1)[1])]
    return host, path, max(fit, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.ruled) for r in trust.judged(pages).collect()), key=str)
    verdict = {r.rule: r.verdict for r in trust.RULES}
    assert got == sorted(((i, *(b := brute(url)), verdict.get(b[2])) for i, url, _, _ in ROWS), key=str)
    assert urlsplit(ROWS[0][1]).path == brute(ROWS[0][1])[1]


def test_equal_rules_take_the_first(spark):
    rules = (trust.Rule("block", "a.b/"), trust.Rule("allow", "b/xx"), trust.Rule("allow", "a.b/"))
    pages = spark.createDataFrame([page(1, "http://a.b/xx"), page(2, "http://a.b/y")], SCHEMA)
    assert {r.page_id: r.ruled for r in trust.judged(pages, rules).collect()} == {1: "block", 2: "block"}


def test_verdicts_match_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    pages = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.page_id: r for r in trust.verdicts(pages).collect()}
    table = pages.toArrow()  # noqa: F841
    con = duckdb.connect()
    con.register("pages", table)
    columns = ("page_id", "host", "path", "rule", "verdict", "trust", "distrust")
    expected = sorted(con.sql(f"select {', '.join(columns)} from ({trust.oracle()})").fetchall(), key=str)
    assert sorted((tuple(getattr(r, c) for c in columns) for r in trust.verdicts(pages).collect()), key=str) == expected
    # bad.net and spam.net link to a host with blocked pages; x.com vouches for friend.net.
    assert got[11].verdict == "block" and got[None].verdict == "block"
    assert got[12].verdict == "allow" and got[12].trust > 0
    assert got[9].verdict == "allow" and got[9].trust == got[9].distrust == 0


def test_ranks_are_personalised_pagerank(spark):
    edges = [("trust", 0, 1, 3), ("trust", 0, 2, 1), ("trust", 1, 0, 1), ("trust", 2, 2, 5), ("trust", 3, 0, 1)]
    seeds = [("trust", 0, 2), ("trust", 3, 1)]
    frame = spark.createDataFrame([(k, f"h{a}", f"h{b}", w) for k, a, b, w in edges], "kind string, src string, dst string, weight bigint")
    start = spark.createDataFrame([(k, f"h{a}", w) for k, a, w in seeds], "kind string, host string, weight bigint")
    got = {r.host: int(r.mass) / trust.MASS for r in trust.ranks(frame, start, Scratch(spark, "t")).collect()}
    rank = seed = [2 / 3, 0, 0, 1 / 3]
    for turn in range(trust.MOST_ROUNDS):
        before, rank = rank, [0.15 * seed[0] + 0.85 * (rank[1] + rank[3]), 0.85 * rank[0] * 0.75,
                              0.85 * (rank[0] * 0.25 + rank[2]), 0.15 * seed[3]]
        if sum(abs(a - b) for a, b in zip(before, rank)) * trust.SETTLED <= 1:
            break
    assert 10 < turn < trust.MOST_ROUNDS - 1
    assert got == pytest.approx({f"h{i}": x for i, x in enumerate(rank)}, abs=1e-9)


def test_ranks_reach_far_along_unquoted_links(spark):
    rows = [(0, "http://org/", "<a href=http://h1.net/x>", "x")]
    rows += [(i, f"http://h{i}.net/", f"<A class=b HREF = http://h{i + 1}.net/y title=t><a href='//h{i + 1}.net'>", "x") for i in range(1, 25)]
    got = {r.host: r for r in trust.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[f"h{i}.net"].trust > 0 for i in range(1, 25))
    assert got["h24.net"].trust < got["h1.net"].trust


def test_empty_table_and_no_seeds(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    assert trust.verdicts(pages.limit(0)).count() == 0
    assert {r.verdict for r in trust.verdicts(pages.filter("page_id in (5, 9, 12)")).collect()} <= {"allow"}


def test_main_path_runs_no_python(spark, capsys):
    trust.verdicts(spark.createDataFrame(ROWS, SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "Cartesian"))
