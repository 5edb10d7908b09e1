"""URL filters whose block decisions follow redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartpost.llm.components import connected_components
from chartpost.llm.tables import broadcast_if_bounded, session, store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Up to this many rules are one expression over the url; more are joined, with the same result.
INLINE_RULES = 1000


FOUND = "struct<size:int,rule:string,verdict:string>"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path prefix, like "example.net/en/"."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_of(url: str) -> Column:
    """Between the first :// and the path, query or fragment, A-Z lower-cased; "" without."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: Sequence[Rule], host: str, path: str) -> Column:
    """The longest rule that fits (struct of size, rule, verdict), or null.

    A rule fits its host and all subdomains when the path begins with the rule's.
    """
    none = F.lit(None).cast(FOUND)
    if not rules:
        return none
    fitting = [
        F.when(
            ((F.col(host) == rule.host) | F.endswith(F.col(host), F.lit("." + rule.host)))
            & F.startswith(F.col(path), F.lit(rule.path)),
            F.struct(F.lit(len(rule.text)).alias("size"), F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict")),
        )
        for rule in rules
    ]
    return F.greatest(*fitting, none)


def rules_table(rules: DataFrame) -> DataFrame:
    """Rows (verdict, text) as host, path and what a fitting rule gives; null texts go."""
    text, host = F.col("text"), F.substring_index("text", "/", 1)
    found = F.struct(F.length(text).alias("size"), text.alias("rule"), F.col("verdict").cast("string").alias("verdict"))
    path = F.expr("substring(text, length(_host) + 1)")
    named = rules.select(F.col("text").cast("string"), "verdict").where("text is not null").withColumn("_host", host)
    # A text given twice judges as its greater verdict, as in an expression.
    return named.groupBy("_host", path.alias("_path")).agg(F.max(found).alias("_found"))


def places_ruled(places: DataFrame, rules: DataFrame, host: str, path: str) -> DataFrame:
    """The longest of ``rules`` per distinct (host, path) that any fits, in ``_own``.

    Equal joins only: a host meets its suffixes among the rules' hosts, then the path's
    prefixes of the lengths that these have meet the rules' paths.  Many rules of one
    host are never all compared with a url.
    """
    labels = F.split(F.col(host), r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    table = store(rules_table(rules), "url-rules")
    lengths = store(
        table.groupBy(F.col("_host").alias("_suffix")).agg(F.collect_set(F.length("_path")).alias("_lengths")),
        "url-rule-lengths",
    )
    hosts = places.select(host).distinct().withColumn("_suffix", F.explode(suffixes))
    known = store(hosts.join(lengths, "_suffix"), "url-rule-hosts")
    tries = (
        places.select(host, path).distinct()
        .join(known, host)
        .withColumn("_length", F.explode(F.filter("_lengths", lambda n: n <= F.length(path))))
        .withColumn("_path", F.col(path).substr(F.lit(1), F.col("_length")))
    )
    fits = tries.join(table, (F.col("_suffix") == F.col("_host")) & (tries["_path"] == table["_path"]))
    return store(fits.groupBy(host, path).agg(F.max("_found").alias("_own")), "ruled-urls")


def with_rule(rows: DataFrame, rules: Sequence[Rule] | DataFrame, host: str, path: str, name: str) -> DataFrame:
    """``rows`` with the longest rule that fits (struct of size, rule, verdict, or null) in ``name``."""
    if not isinstance(rules, DataFrame):
        if len(rules) <= INLINE_RULES:
            return rows.withColumn(name, rule_of(rules, host, path))
        rules = rows.sparkSession.createDataFrame([(r.verdict, r.text) for r in rules], "verdict string, text string")
    found = places_ruled(rows, rules, host, path).withColumnRenamed("_own", name)
    return rows.join(broadcast_if_bounded(found), [host, path], "left")


def key_of(url: str) -> Column:
    """What names a page: the url without scheme and fragment, host lower-cased; null if no url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(F.col(url), "://") > 0, F.concat(host_of(url), rest))


def _tags(html: str, tag: str, having: str) -> Column:
    """All tags of a kind with such an attribute."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>"), 0)
    return F.filter(tags, lambda x: x.rlike(having))


def _attribute(tag: Column, name: str) -> Column:
    return F.trim(
        F.coalesce(
            F.nullif(F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*\"([^\"]*)\"", 1), F.lit("")),
            F.nullif(F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*'([^']*)'", 1), F.lit("")),
            F.nullif(F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*([^\s\"'>]+)", 1), F.lit("")),
        )
    )


def resolved(link: str, url: str) -> Column:
    """``link`` as an absolute url, relative to ``url``; null for an empty one."""
    to, base = F.col(link), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(url, r"(?s)^(.*?):", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*((?:[^?#]*/)?)", 1)
    return (
        F.when((to == "") | F.startswith(to, F.lit("#")), None)
        .when(to.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(F.startswith(to, F.lit("//")), F.concat(scheme, F.lit(":"), to))
        .when(F.startswith(to, F.lit("/")), F.concat(base, to))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), to))
    )


def links_of(pages: DataFrame) -> DataFrame:
    """Edges (a, b) of keys: each page with all its canonical links and refresh targets."""
    low, none = F.lower("html"), F.array().cast("array<string>")
    canonical = F.when(
        F.contains(low, F.lit("canonical")),
        F.transform(
            _tags("html", "link", r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"),
            lambda tag: _attribute(tag, "href"),
        ),
    )
    refresh = F.when(
        F.contains(low, F.lit("http-equiv")),
        F.transform(
            _tags("html", "meta", r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"),
            lambda tag: F.regexp_extract(_attribute(tag, "content"), r"(?is)\burl\s*=\s*['\"]?([^'\"]*)", 1),
        ),
    )
    links = F.array_distinct(F.concat(F.coalesce(canonical, none), F.coalesce(refresh, none)))
    found = pages.select("url", F.explode(links).alias("link")).where("link is not null")
    ends = found.select("url", resolved("link", "url").alias("to"))
    return ends.select(key_of("url").alias("a"), key_of("to").alias("b")).where("a <> b")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] | DataFrame, redirects: DataFrame | None = None
) -> DataFrame:
    """page_id, host, path, rule and verdict per row of ``pages`` (page_id, url, html).

    ``rules`` are a list, or a table (verdict, text) of any size.

    A url's own rule decides.  Without one, its aliases do: all urls joined to it by
    canonical links, refreshes and ``redirects`` (from_url, to_url), over any number of
    steps and whether or not they are pages.  A rule that allows one of them outranks
    rules that block others; else one block blocks all.  Otherwise the url is allowed.
    Every canonical link and refresh of a page counts; empty ones are none.

    Null urls and urls without :// have empty host and path, no rule and no aliases;
    null html has no links; rows that repeat a page are judged alike.  An
    empty table gives no rows; other columns are ignored.
    """
    session(pages.sparkSession)
    urls = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    edges = links_of(pages.select(F.col("url").cast("string"), F.col("html").cast("string")))
    if redirects is not None:
        named = redirects.select(F.col("from_url").cast("string"), F.col("to_url").cast("string"))
        edges = edges.unionByName(
            named.select(key_of("from_url").alias("a"), key_of("to_url").alias("b")).where("a <> b")
        )
    roots = store(connected_components(edges), "url-roots")
    # A key is a url without its scheme.
    nodes = roots.withColumn("url", F.concat(F.lit("://"), "node")).select(
        "node", "root", host_of("url").alias("h"), path_of("url").alias("p")
    )
    marked = with_rule(nodes, rules, "h", "p", "own").select("root", F.col("own.verdict").alias("v"))
    groups = marked.groupBy("root").agg(F.bool_or(F.col("v") == "allow").alias("some"), F.bool_or(F.col("v") == "block").alias("none"))
    blocked = groups.where("none and not coalesce(some, false)").select("root")
    aliases = store(roots.join(blocked, "root", "left_semi").select(F.col("node").alias("_key")), "blocked-urls")
    parsed = urls.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"), key_of("url").alias("key"))
    parsed = with_rule(parsed, rules, "host", "path", "own")
    joined = parsed.join(broadcast_if_bounded(aliases), F.col("key") == F.col("_key"), "left")
    by_alias = F.when(F.col("_key").isNotNull(), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", by_alias).alias("verdict")
    )
