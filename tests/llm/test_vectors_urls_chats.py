"""Exact search, url aliases, mixing and role repair against plain versions."""

import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartpost.llm import exact_topk, mixing, role_repair, url_aliases
from chartpost.llm.mixing import Target, mix, mixed_documents
from chartpost.llm.role_repair import Costs, repair_conversations
from chartpost.llm.url_aliases import Rule, judge_urls

# --- exact search ---------------------------------------------------------------------


def vectors():
    rng = random.Random(9)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)]
    odd = [None, [math.nan] * 6, [math.inf] + [0.0] * 5, [None] + [0.1] * 5]
    rows += [(1000 + 20 * i, v) for i, v in enumerate(odd)]
    return rows + [rows[40], (None, rows[1][1]), (2000, [0.5, 0.5]), (2001, [0.25, 0.5])]


def plain_top(rows, k):
    """Every row is a vector of its own, also where rows share an id."""
    sound = [
        (vec_id, [math.floor(64 * float(np.float32(x))) for x in v])
        for vec_id, v in rows
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, asked) in enumerate(sound):
        if q % 20 == 0:
            others = [(i, v) for n, (i, v) in enumerate(sound) if n != at and len(v) == len(asked)]
            scored = [(-sum(a * b for a, b in zip(asked, v)), i) for i, v in others]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k", [5, 400])
def test_top_k(spark, monkeypatch, k):
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(exact_topk, "CANDIDATE_ROWS", 50)
    table = spark.createDataFrame([(i, v, 1) for i, v in vectors()], "vec_id long, embedding array<float>, score int")
    got = exact_topk.top_k(table, F.col("vec_id") % 20 == 0, k).collect()
    assert sorted(map(tuple, got)) == plain_top(vectors(), k)


def test_large_components_and_unlike_rows_of_one_id(spark):
    rows = [(0, [float(1 << 20)] * 64), (0, [1.0] * 64), (1, [float(1 << 20)] * 64), (2, [1.0] * 64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, exact_topk.top_k(table, F.col("vec_id") == 0, 1).collect()))
    assert got == [(0, 1, 0, 1 << 38), (0, 1, 1, 1 << 58)]
    wide = spark.createDataFrame([(0, [float(1 << 24)] * 64), (1, [float(1 << 24)] * 64)], table.schema)
    with pytest.raises(ValueError):
        exact_topk.top_k(wide, F.col("vec_id") == 0, 1)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(empty, F.col("vec_id") % 20 == 0, 3).count() == 0


def test_ties_by_position():
    assert exact_topk.top_of(np.array([1, 5, 5, 5, 0]), 2).tolist() == [1, 2]
    assert exact_topk.top_of(np.array([1, 5]), 9).tolist() == [1, 0]


# --- urls -----------------------------------------------------------------------------

RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


def page(url, canonical=None, refresh=None):
    html = "<html>"
    if canonical:
        html += f'<link rel="stylesheet" href="/s.css"><LINK href=\'{canonical}\' rel="canonical">'
    if refresh:
        html += f'<meta http-equiv="refresh" content="0; URL={refresh}">'
    return url, html


PAGES = [
    page("https://x.Example.NET/fr/1"), page("https://x.example.net/en/1#top"), page("http://a.com/en/1"),
    page("http://a.com/en/2", canonical="https://bad.net/1"), page("http://a.com/en/3", refresh="/en/2"),
    page("http://b.com/x/4", canonical="../q"), page("http://b.com/5", canonical="//ok.org/fr/1", refresh="http://bad.net/"),
    page("https://c.com/6", canonical="https://c.com/6#part"), (None, "<html>"), ("no scheme", None), page("http://net/"),
    page("http://example.com/de/1"), page("http://notexample.com/de/1"), page("http://x.net"), page("http://x.net?a=/b"),
    page("https://a.com/en/3"), page("http://ok.org/fr/9", canonical="http://bad.net/9"), page("http://a.com/en/2"),
]
WANT = [
    ("x.example.net", "/fr/1", "net/", "block"), ("x.example.net", "/en/1", "example.net/en/", "allow"),
    ("a.com", "/en/1", None, "allow"), ("a.com", "/en/2", None, "block"), ("a.com", "/en/3", None, "block"),
    ("b.com", "/x/4", None, "allow"), ("b.com", "/5", None, "allow"), ("c.com", "/6", None, "allow"),
    ("", "", None, "allow"), ("", "", None, "allow"), ("net", "/", "net/", "block"),
    ("example.com", "/de/1", "example.com/de/", "block"), ("notexample.com", "/de/1", None, "allow"),
    ("x.net", "", None, "allow"), ("x.net", "", None, "allow"), ("a.com", "/en/3", None, "block"),
    ("ok.org", "/fr/9", "org/fr/", "allow"), ("a.com", "/en/2", None, "block"),
]


def test_urls_follow_their_aliases(spark):
    table = spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(PAGES)], "page_id long, url string, html string, host string")
    got = {r.page_id: tuple(r)[1:] for r in judge_urls(table, RULES).collect()}
    assert got == dict(enumerate(WANT))


def test_redirects_given_apart(spark):
    table = spark.createDataFrame([(1, "http://one.com/", None), (2, "http://two.com/a?b#c", "")], "page_id long, url string, html string")
    moves = [("http://one.com/", "https://two.com/a?b"), ("http://two.com/a?b", "http://bad.net/x"), (None, "http://bad.net/"), ("http://q.com", None)]
    redirects = spark.createDataFrame(moves, "from_url string, to_url string")
    assert {r.page_id: r.verdict for r in judge_urls(table, RULES, redirects).collect()} == {1: "block", 2: "block"}
    allowed = redirects.union(spark.createDataFrame([("http://z.org/fr/", "http://bad.net/x")], redirects.schema))
    assert {r.page_id: r.verdict for r in judge_urls(table, RULES, allowed).collect()} == {1: "allow", 2: "allow"}


def test_no_pages(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0


def test_no_rules(spark):
    table = spark.createDataFrame([(1, "http://a.net/x", None)], "page_id long, url string, html string")
    assert [tuple(r) for r in judge_urls(table, ()).collect()] == [(1, "a.net", "/x", None, "allow")]


def test_joined_rules_judge_like_an_expression(spark):
    """A table of 100,000 rules, most for hosts that no page has, many for one host."""
    rng = random.Random(4)
    hosts = ["a.com", "x.a.com", "com", "", "b.org", "x.b.org.", "net"]
    own = {(v, f"{h}/{p}") for h in hosts for p in ("", "en", "en/", "en/1", "fr/é") for v in ("block", "allow") if rng.random() < 0.4}
    own |= {("block", "a.com"), ("block", "b.org/en"), ("allow", "b.org/en")}
    urls = [f"http://{s}{h}/{p}" for s in ("", "y.") for h in hosts for p in ("", "en", "en/12", "fr/é?x", "EN/")]
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate([*urls, *urls, None, "none"])], "page_id long, url string, html string")
    few = [Rule(*r) for r in sorted(own)]
    far = spark.range(100_000).selectExpr("'block' AS verdict", "concat('far', id % 50000, '.example/', id, '/') AS text")
    hot = spark.range(2_000).selectExpr("'block' AS verdict", "concat('a.com/zz', id) AS text")
    listed = spark.createDataFrame([*sorted(own), ("block", None)], "verdict string, text string")
    want = sorted(map(tuple, judge_urls(pages, few).collect()), key=str)
    assert {v for *_, v in want} == {"block", "allow"}
    assert sorted(map(tuple, judge_urls(pages, listed.union(far).union(hot)).collect()), key=str) == want
    long_list = [*few, *[Rule("block", f"far{i}.example/") for i in range(url_aliases.INLINE_RULES)]]
    assert sorted(map(tuple, judge_urls(pages, long_list).collect()), key=str) == want


def test_every_tag_makes_an_edge(spark):
    """An empty first tag hides nothing, and later tags count as well."""
    empty = '<link rel="canonical" href=""><link rel="canonical" href="http://bad.net/1">'
    second = '<link rel=canonical href="http://good.com/"><link rel=canonical href="http://bad.net/2">'
    third = '<meta http-equiv="refresh" content="5"><meta http-equiv="refresh" content="0; url=http://bad.net/3">'
    pages = [(1, "http://p.com/1", empty), (2, "http://p.com/2", second), (3, "http://p.com/3", third), (4, "http://good.com/", ""), (5, "http://p.com/5", "<link rel=canonical>")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in judge_urls(table, RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}


def test_sql_of_urls_takes_every_tag(spark):
    duckdb = pytest.importorskip("duckdb")
    from chartpost.llm.oracle import ORACLE

    pages = [(1, "http://p.com/1", '<link rel="canonical" href=""><link rel="canonical" href="http://bad.net/1">'), (2, "http://p.com/2", None), (3, "http://bad.net/1", "")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    connection = duckdb.connect()
    connection.register("pages", table.toPandas())
    names = ["page_id", "host", "path", "rule", "verdict"]
    plain = connection.execute(f"SELECT {', '.join(names)} FROM ({ORACLE['op9_url_aliases']})").fetchall()
    assert sorted(plain) == sorted(tuple(r) for r in judge_urls(table, RULES).select(*names).collect())



# --- mixing ---------------------------------------------------------------------------

MIX_SCHEMA = "doc_id long, text string, source string, weight string, pass string"


def mix_rows():
    rng = random.Random(4)
    rows = []
    for source, count in (("big", 600), ("mid", 120), ("small", 40), (None, 30)):
        rows += [(len(rows) + i, " ".join("w" * rng.randint(1, 30)), source, "c", "c") for i in range(count)]
    return rows + [(5000, None, "small", "c", "c"), (5001, "", "mid", "c", "c"), (5002, None, "empty", "c", "c"), (None, "no id at all", "mid", "c", "c"), (7, "again w w", "big", "c", "c")]


def tokens_of(rows):
    out = {}
    for _, text, source, *_ in rows:
        out[source] = out.get(source, 0) + len((text or "").split())
    return {s: n for s, n in out.items() if n}


def plain_weights(tokens, a):
    total = sum(tokens.values())
    power = {s: (n / total) ** a for s, n in tokens.items()}
    return {s: p / sum(power.values()) for s, p in power.items()}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights.values())


@pytest.mark.parametrize("target,budget", [(Target(0.95, 50.0), None), (Target(0.0, 1.5), None), (Target(0.99, 2.0), None), (Target(0.97, 9.0), 0.5)])
def test_mix(spark, target, budget):
    rows = mix_rows()
    tokens = tokens_of(rows)
    total = sum(tokens.values())
    got = mix(spark.createDataFrame(rows, MIX_SCHEMA), target, budget).collect()
    weights = {r.source: r.weight for r in got}
    assert set(weights) == set(tokens) and sum(weights.values()) == pytest.approx(1)

    # The weights are natural shares to some power, and that power meets the target.
    a = math.log(weights["big"] / weights["small"]) / math.log(tokens["big"] / tokens["small"])
    assert weights == pytest.approx(plain_weights(tokens, a), abs=1e-5)
    drawn = budget * total if budget else max(tokens[s] / weights[s] for s in tokens)
    repeats = max(drawn * weights[s] / tokens[s] for s in tokens)
    limit = math.log(len(tokens))
    higher = plain_weights(tokens, min(1, a + 1e-3))
    assert repeats <= target.max_repeats + 1e-4
    assert entropy(weights) >= target.entropy * limit - 1e-5 or repeats == pytest.approx(target.max_repeats, abs=1e-3)
    assert a == pytest.approx(1) or entropy(higher) < target.entropy * limit or repeats == pytest.approx(target.max_repeats, abs=1e-3)

    by_source = {}
    for r in got:
        by_source.setdefault(r.source, {}).setdefault(r["pass"], []).append(r)
    for source, passes in by_source.items():
        units = [(d, len((t or "").split())) for d, t, s, *_ in rows if s == source or s is None and source is None]
        whole = int(drawn * weights[source] / tokens[source] + 1e-6)
        for number in range(whole):
            assert sorted((r.doc_id for r in passes[number]), key=repr) == sorted((d for d, _ in units), key=repr)
        rest = drawn * weights[source] - whole * tokens[source]
        last = passes.get(whole, [])
        used = sum(r.n_tokens for r in last)
        assert used <= rest + 1 and set(passes) <= set(range(whole + 1))
        # The partial pass is a prefix of its permutation that the next unit would overfill.
        place = spark.range(1).select(*[F.xxhash64(F.lit(0), F.lit(whole).cast("long"), F.lit(d).cast("long")).alias(f"c{i}") for i, (d, _) in enumerate(units)]).first()
        ordered = {}
        for key, (d, n) in sorted((p % (1 << 64) >> 1, u) for p, u in zip(place, [(d if d is not None else -1, n) for d, n in units])):
            ordered[key] = ordered.get(key, 0) + n
        running, want = 0, 0
        for n in ordered.values():
            if running + n > math.floor(rest + 1e-6):
                break
            running += n
        assert abs(used - running) <= 0 or source is not None and abs(rest - round(rest)) < 1e-3
    if budget is None:
        assert {r.doc_id for r in got} >= {d for d, _, s, *_ in rows if s in tokens}


def test_mixed_documents_keep_their_columns(spark):
    table = spark.createDataFrame(mix_rows(), MIX_SCHEMA)
    copies = mix(table, Target(0.95, 2.0)).groupBy("doc_id").count().collect()
    out = mixed_documents(table, Target(0.95, 2.0))
    assert out.columns == table.columns
    assert {tuple(r) for r in out.collect()} <= set(mix_rows())
    assert sorted(((r.doc_id, r["count"]) for r in out.groupBy("doc_id").count().collect()), key=repr) == sorted(((r.doc_id, r["count"]) for r in copies), key=repr)


def test_nothing_to_mix(spark):
    assert mix(spark.createDataFrame([], MIX_SCHEMA)).count() == 0
    assert mix(spark.createDataFrame([(1, None, "s", "c", "c")], MIX_SCHEMA)).count() == 0


# --- role repair ----------------------------------------------------------------------


def plain_cost(roles, costs):
    """Least cost by trying every way for every turn."""
    if not roles:
        return 0
    names = role_repair.ROLES
    best = {role_repair.START: 0}

    def inserted(states):
        states = dict(states)
        for _ in range(4):
            for state, cost in list(states.items()):
                for after in role_repair.NEXT[state]:
                    states[after] = min(states.get(after, 1 << 60), cost + costs.insert)
        return states

    for role in roles:
        found = {}
        for state, cost in best.items():
            if state != role_repair.START:
                found[state] = min(found.get(state, 1 << 60), cost + costs.merge + costs.relabel * (names[state] != role))
        for state, cost in inserted(best).items():
            for after in role_repair.NEXT[state]:
                found[after] = min(found.get(after, 1 << 60), cost + costs.relabel * (names[after] != role))
        best = found
    return min(c for s, c in inserted(best).items() if s in role_repair.FINAL)


def checked(spark, conversations, costs):
    rows = [(c, t, role, f"{c}/{t}") for c, roles in conversations.items() for t, role in enumerate(roles)]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, cost string")
    found = {}
    for r in repair_conversations(table, costs).collect():
        found.setdefault(r.conv_id, []).append(r)
    assert set(found) == set(conversations)
    for conv_id, roles in conversations.items():
        segments = sorted(found[conv_id], key=lambda r: r.seq)
        assert len({s.seq for s in segments}) == len(segments)
        assert sum(s.cost for s in segments) == plain_cost(roles, costs), roles
        assert [s.turn for s in segments if s.turn is not None] == list(range(len(roles)))
        state, text = role_repair.START, ""
        for s in segments[:-1]:
            if not s.action.startswith("merge"):
                after = role_repair.ROLES.index(s.role)
                assert after in role_repair.NEXT[state]
                text += "<|end|>\n" * bool(text) + f"<|{s.role}|>\n"
                state = after
            else:
                assert s.role == role_repair.ROLES[state]
                text += "\n"
            text += f"{conv_id}/{s.turn}" if s.turn is not None else ""
        assert state == role_repair.ASSISTANT and segments[-1].action == "end"
        assert "".join(s.rendered for s in segments) == text + "<|end|>\n"


def test_every_short_conversation(spark):
    kinds = ("system", "user", "assistant", None)
    lists = [list(p) for n in (1, 2, 3, 4) for p in product(kinds, repeat=n)]
    checked(spark, dict(enumerate(lists)), Costs())


@pytest.mark.parametrize("costs", [Costs(5, 1, 4), Costs(2, 2, 1), Costs(1, 9, 9)])
def test_long_conversations_cross_partitions(spark, costs):
    rng = random.Random(11)
    lists = {k: [rng.choice(("user", "assistant", "system", "tool", "user")) for _ in range(n)] for k, n in enumerate((900, 3, 50, 1))}
    checked(spark, {**lists, None: ["user", "user"]}, costs)


def test_stretches_compose():
    roles = ["user", "user", "system", "assistant", None, "assistant", "user"]
    whole = role_repair.matrix(roles[0], Costs())
    for role in roles[1:]:
        whole = role_repair.compose(whole, role_repair.matrix(role, Costs()))
    ends = whole[role_repair.START] + [role_repair.end_cost(s, Costs()) for s in range(4)]
    assert min(ends) == plain_cost(roles, Costs())


def test_no_turns_and_null_text(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair_conversations(spark.createDataFrame([], schema)).count() == 0
    rows = repair_conversations(spark.createDataFrame([(1, None, "user", None), (1, None, "user", None)], schema)).orderBy("seq").collect()
    assert [r.action for r in rows] == ["keep", "merge", "insert", "end"]
