"""URL filters: rules by host and path, and link-graph propagation for what no rule covers.

Trust is a personalised PageRank from the hosts that rules allow, along links; distrust one
from the hosts that rules block, against the links (who links to a blocked host is suspect).
A seed's weight is the share of its ruled pages that are allowed, or blocked. A page without a
rule is blocked where its host has more distrust than ``threshold`` times its trust; a host
that neither reaches is allowed.

Scale: links are counted per pair of hosts before anything is joined; scores have one row per
host and kind, both kinds in one table, so a round is one join and one aggregation over the
edges. Every few rounds the scores are written below ``spark.checkpoint.dir``, and only the
largest change reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

DAMPING = 0.85
ROUNDS = 20
TOLERANCE = 1e-12  # change of a score, relative to it
EVERY = 4  # rounds between two written tables
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the page's path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# fixed values: the rules of the query
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): anchors between different hosts, counted. Relative links stay on their host."""
    link = F.explode(F.regexp_extract_all(F.col(f"`{html_col}`"), F.lit(HREF), F.lit(1)))
    found = pages.select(host_of(F.col(f"`{url_col}`")).alias("src"), link.alias("link"))
    absolute = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).when(
        F.col("link").rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), F.col("link"),
    )
    found = found.select("src", host_of(absolute).alias("dst")).filter("src != '' and dst != '' and src != dst")
    return found.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = ROUNDS) -> DataFrame:
    """(host, trust, distrust) of every host that either reaches.

    ``links``: src, dst, n; ``seeds``: host, trust, distrust (weights). Fixed point of
    score = (1 - damping) * seed + damping * (sum over edges of share * score), followed for
    ``rounds`` rounds (None: as many as it takes), or until no host is new and no score changes by
    ``TOLERANCE`` of itself: about 170 rounds, and as many as the longest chain has links. Trust shares a host's score among the
    hosts it links to, by number of links; distrust among the hosts that link to it.
    """
    out_n = links.groupBy("src").agg(F.sum("n").alias("total"))
    in_n = links.groupBy("dst").agg(F.sum("n").alias("total"))
    forward = links.join(out_n, "src").select(F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), (F.col("n") / F.col("total")).alias("share"))
    backward = links.join(in_n, "dst").select(F.lit("d").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), (F.col("n") / F.col("total")).alias("share"))
    edges = stored(forward.unionByName(backward), "host-edges")
    start = seeds.select(F.explode(F.array(
        F.struct(F.lit("t").alias("kind"), "host", F.col("trust").alias("seed")),
        F.struct(F.lit("d").alias("kind"), "host", F.col("distrust").alias("seed")),
    )).alias("s")).select("s.*").filter("seed > 0")
    base = stored(start.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score")), "host-seeds")
    scores, done = base, 0
    while rounds is None or done < rounds:
        before = scores
        for _ in range(EVERY if rounds is None else min(EVERY, rounds - done)):
            passed = scores.alias("s").join(edges.alias("e"), F.expr("s.kind = e.kind and s.host = e.a")).select(
                "s.kind", F.col("b").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"),
            )
            scores = base.unionByName(passed).groupBy("kind", "host").agg(F.sum("score").alias("score"))
            done += 1
        scores = stored(scores, "host-scores")
        change = scores.alias("n").join(before.alias("o"), ["kind", "host"], "left").agg(
            F.max(F.abs(F.col("n.score") - F.coalesce(F.col("o.score"), F.lit(0.0))) / F.nullif(F.col("n.score"), F.lit(0.0))),
        ).first()[0]
        if (change or 0.0) < TOLERANCE:
            break
    side = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0))
    return scores.groupBy("host").agg(side("t").alias("trust"), side("d").alias("distrust"))


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 1.0, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """(id_col, host, path, rule, verdict, trust, distrust) of every page.

    A null url, or one without ``://``, has an empty host and path, no rule and verdict allow.
    Null or odd html has no links. Repeated rows are judged each; ids may be null; other
    columns are left out; an empty table gives an empty result.
    """
    url = F.col(f"`{url_col}`")
    ruled = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = stored(ruled.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)), "ruled-pages")
    verdict = F.col("r.verdict")
    seeds = ruled.filter("r is not null and host != ''").groupBy("host").agg(
        F.avg((verdict == "allow").cast("double")).alias("trust"), F.avg((verdict == "block").cast("double")).alias("distrust"),
    )
    scores = propagate(stored(host_links(pages, url_col, html_col), "host-links"), seeds, rounds=None)
    by_method = F.when(F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow")
    return ruled.join(scores, "host", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(verdict, by_method).alias("verdict"), "trust", "distrust",
    )


def oracle_sql(pages: str = "pages", rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> str:
    """The verdicts in DuckDB SQL: the same rounds, one CTE each."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    fits = lambda r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.name}'" for r in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in ordered) + " END"
    steps = "".join(
        f"""
    s{i} AS MATERIALIZED (
      SELECT kind, host, sum(score) AS score FROM (
        SELECT * FROM base UNION ALL
        SELECT s.kind, e.b, s.score * e.share * {DAMPING}::DOUBLE FROM s{i - 1} s JOIN edges e ON s.kind = e.kind AND s.host = e.a
      ) GROUP BY ALL),"""
        for i in range(1, rounds + 1)
    )
    return f"""
    WITH p AS (
      SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)\\A.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '(?s)\\A.*?://[^/?#]*([^?#]*)', 1) AS path
      FROM {pages}
    ), ruled AS MATERIALIZED (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled FROM p),
    anchors AS (
      SELECT host AS src, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']?([^"''\\s>]+)', 1)) AS link FROM p
    ), targets AS (
      SELECT src, translate(regexp_extract(CASE WHEN starts_with(link, '//') THEN 'x:' || link
               WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link ELSE '' END,
               '(?s)\\A.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS dst FROM anchors
    ), links AS MATERIALIZED (
      SELECT src, dst, count(*)::DOUBLE AS n FROM targets WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL
    ), edges AS MATERIALIZED (
      SELECT 't' AS kind, src AS a, dst AS b, n / sum(n) OVER (PARTITION BY src) AS share FROM links
      UNION ALL SELECT 'd', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM links
    ), seeds AS (
      SELECT host, avg((ruled = 'allow')::INT::DOUBLE) AS trust, avg((ruled = 'block')::INT::DOUBLE) AS distrust
      FROM ruled WHERE ruled IS NOT NULL AND host <> '' GROUP BY host
    ), base AS MATERIALIZED (
      SELECT 't' AS kind, host, trust * (1 - {DAMPING}::DOUBLE) AS score FROM seeds WHERE trust > 0
      UNION ALL SELECT 'd', host, distrust * (1 - {DAMPING}::DOUBLE) FROM seeds WHERE distrust > 0
    ), s0 AS (SELECT * FROM base),{steps}
    scores AS (
      SELECT host, coalesce(max(score) FILTER (WHERE kind = 't'), 0) AS trust,
             coalesce(max(score) FILTER (WHERE kind = 'd'), 0) AS distrust FROM s{rounds} GROUP BY host
    )
    SELECT page_id, r.host, path, rule, coalesce(ruled, CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
    FROM ruled r LEFT JOIN scores s ON r.host = s.host"""
