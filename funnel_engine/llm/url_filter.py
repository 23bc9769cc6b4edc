"""URL filter with a token index, in DataFrame operations only.

Rules are patterns in the usual filter-list syntax over ``host + path``:
``||`` anchors at the host or any parent domain of it, ``|`` at the start, ``*``
matches anything, ``^`` a separator or the end; all else is literal, in upper or lower
case (A-Z) but for the named rules, whose paths are taken as written. A rule's
complete literal tokens are its runs of letters and digits that cannot continue
in a matching URL. Each rule is filed under the one of them that is rarest in
all URLs. The tokens of a URL fetch its candidate rules through that index, and
only those run their regular expressions. A rule without a complete token is
filed under the empty token, which every URL has.

Named rules (``rule`` not null) beat patterns, the longest one first; an
allowing pattern beats a blocking one; a URL that nothing matches is allowed.

Null URLs and URLs without ``://`` have an empty host and path. Each input row
gives one output row, repeated rows and null ids included. Rules of one length that fit
one URL are one rule. URLs of any length are judged whole; an empty table gives no rows.
Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (verdict, host and path): fits the host and its subdomains if the path starts with the rule's.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: Blocked by class of site, for URLs that no rule fits. ``||x-`` and ``||x.`` take a host label that starts with or is x,
#: ``-x.`` one that ends with it: whole tokens, so that ``downloads-``, ``alphabets.`` and ``casinos`` stay.
BLOCKED = {
    "gambling": ["||casino-", "-casino.", "/casino/", "-casinos.", "||bets-", "-bets.", "||betting-", "-betting.", "||poker-", "-poker.", "||jackpot-", "-jackpot.", "||sportsbook-", "-sportsbook."],
    "ads and tracking": ["||ads.", "||ads-", "||adserver.", "||adserver-", "-adserver.", "/adserver/", "||adtrack.", "||adtrack-", "||doubleclick.", "||popunder-", "-popunder."],
    "adult": ["||adult-", "||xxx.", "||xxx-", "-xxx.", "||porn.", "||porn-", "-porn."],
    "pharmacy": ["||cheap-pills.", "||cheap-pills-", "||cheap-meds.", "||cheap-meds-", "||pills-", "-pills.", "||viagra-", "-viagra.", "||cialis-", "-cialis."],
    "spam": ["||spam-farm.", "||spam-farm-", "||link-farm.", "||link-farm-", "*free-download^"],
}
#: Beat the patterns above.
ALLOWED = ["||spam-farm.*/archive/", "||ads-b.", "||adult-education.", "||adult-education-", "||adult-learning.", "||adult-learning-", "||adult-literacy."]
#: (verdict, pattern) for URLs that no rule fits.
PATTERNS = [("block", p) for listed in BLOCKED.values() for p in listed] + [("allow", p) for p in ALLOWED]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: Column | str) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = _lowered(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """Distinct runs of ASCII letters and digits, in lower case; the empty token is always there."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(_lowered(text), "[^a-z0-9]+")))


def default_rules(spark: SparkSession) -> DataFrame:
    rows = [(v, f"||{r}", r) for v, r in RULES] + [(v, p, None) for v, p in PATTERNS]
    listed = F.array(*(F.struct(F.lit(v).alias("verdict"), F.lit(p).alias("pattern"), F.lit(r).cast("string").alias("rule")) for v, p, r in rows))
    return spark.range(1).select(F.inline(listed))


def compiled(rules: DataFrame) -> DataFrame:
    """``rules`` with their regular expression and complete literal tokens."""
    p = F.when(F.col("rule").isNull(), _lowered("pattern")).otherwise(F.col("pattern"))
    body = F.regexp_replace(p, r"^\|{1,2}", "")
    quoted = F.regexp_replace(body, r"([.+?{}()\[\]$\\|])", r"\\$1")
    quoted = F.replace(F.replace(quoted, F.lit("^"), F.lit("(?:[^A-Za-z0-9_.%-]|$)")), F.lit("*"), F.lit(r"[\s\S]*"))
    start = F.when(p.startswith("||"), F.lit(r"^(?:[^/]*\.)?")).when(p.startswith("|"), F.lit("^")).otherwise("")
    # A run next to a wildcard or an open end may be part of a longer token of the URL.
    closed = F.regexp_replace(F.regexp_replace(p, r"[A-Za-z0-9]+(\*|$)", "*"), r"(^|\*)[A-Za-z0-9]+", "*")
    return rules.select("verdict", "pattern", "rule", F.concat(start, quoted).alias("regex"), tokens(closed).alias("tokens"))


def token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule under its literal token that the fewest URLs have."""
    own = rules.select("verdict", "pattern", "rule", "regex", F.explode("tokens").alias("token"))
    counts = (
        urls.select(F.explode(tokens(F.col("key"))).alias("token"))
        .where("token != ''")
        .join(own.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .count()
    )
    # The empty token is the last resort.
    rank = F.struct((F.col("token") == "").alias("none"), F.coalesce("count", F.lit(0)).alias("n"), "token")
    return own.join(counts, "token", "left").groupBy("verdict", "pattern", "rule", "regex").agg(F.min(rank).getField("token").alias("token"))


def filter_urls(pages: DataFrame, rules: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of each row; ``pattern`` is the pattern that decided where no rule did."""
    rules = compiled(rules if rules is not None else default_rules(pages.sparkSession))
    url = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = url_parts(F.col("url"))
    rows = url.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", F.concat("host", "path"))
    urls = rows.select("key").distinct()
    index = token_index(rules, urls)
    fits = (
        urls.select("key", F.explode(tokens(F.col("key"))).alias("token"))
        .join(index, "token")
        .where(F.regexp_like(F.when(F.col("rule").isNull(), _lowered("key")).otherwise(F.col("key")), F.col("regex")))
        .groupBy("key")
        .agg(
            F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "verdict"))).alias("named"),
            F.min(F.when(F.col("rule").isNull(), F.struct("verdict", "pattern"))).alias("other"),  # allow sorts before block
        )
    )
    return rows.join(fits, "key", "left").select(
        "page_id",
        "host",
        "path",
        F.col("named.rule").alias("rule"),
        F.coalesce("named.verdict", "other.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("named").isNull(), F.col("other.pattern")).alias("pattern"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).drop("pattern")


def _fits(r: str) -> str:
    host, _, path = r.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


def _like(p: str) -> str:
    import re

    body = re.sub(r"^\|{1,2}", "", p)
    body = "".join("[\\s\\S]*" if c == "*" else "(?:[^A-Za-z0-9_.%-]|$)" if c == "^" else re.escape(c) for c in body)
    return f"regexp_matches(translate(host || path, '{_UPPER}', '{_LOWER}'), '{'^(?:[^/]*\\.)?' if p.startswith('||') else ''}{body}')"


_LONGEST = sorted(RULES, key=lambda x: -len(x[1]))
OP3_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
)
SELECT page_id, host, path,
  CASE {' '.join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in _LONGEST)} END AS rule,
  CASE {' '.join(f"WHEN {_fits(r)} THEN '{v}'" for v, r in _LONGEST)}
       {' '.join(f"WHEN {_like(p)} THEN '{v}'" for v, p in sorted(PATTERNS))} ELSE 'allow' END AS verdict
FROM h
"""
