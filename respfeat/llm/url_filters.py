"""URL filters: pattern rules found through their rarest literal token.

A rule is a host with a path prefix; it fits the host and its subdomains, and the longest
one wins. A pattern, in which ``*`` stands for anything, decides where no rule fits;
block wins over allow there.

Every rule and pattern has literal tokens: runs of letters and digits that any fitting
URL holds as whole tokens. Rules are indexed by the one that the fewest URLs hold. The
tokens of a URL fetch the rules indexed under them, and only those run their regular
expression. The index is joined by token; Spark broadcasts it while its measured
size allows and shuffles by token beyond that, where common tokens, being nobody's rarest
as a rule, seldom meet.

Defined results: a NULL URL, or one without ``://``, has an empty host and path, meets no
rule and is allowed. Repeated rows are judged each. Where rules tie in length,
block wins. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respfeat.llm.common import LOWER, UPPER, table

#: (host, path, verdict): the rules of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: (pattern, verdict) for URLs that no rule fits.
PATTERNS = [
    ("*://ads.*", "block"),
    ("*://track.*", "block"),
    ("*/casino/*", "block"),
    ("*/porn/*", "block"),
    ("*?redirect=http*", "block"),
    ("*://m.*/de/*", "block"),
]
_TOKENS = "[A-Za-z0-9]+"
_SPLIT = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def host(url: str):
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), UPPER, LOWER)


def path(url: str):
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def _quoted(text):
    return F.regexp_replace(text, r"([^A-Za-z0-9*])", r"\\$1")


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]], patterns: Iterable[tuple[str, str]]) -> DataFrame:
    """rule, verdict, length, regex, tokens. Rules rank by length, patterns lie below them."""
    rows = [(h, p, None, v) for h, p, v in rules] + [(None, None, p, v) for p, v in patterns]
    listed = spark.range(1).select(
        F.explode(
            F.array(*[F.struct(*[F.lit(x).cast("string").alias(n) for x, n in zip(r, ("h", "p", "pattern", "verdict"))]) for r in rows])
            if rows else F.array().cast("array<struct<h:string,p:string,pattern:string,verdict:string>>")
        ).alias("r")
    ).select("r.*")
    any_of = F.regexp_replace(_quoted(F.col("pattern")), r"\*", ".*")
    regex = F.when(
        F.col("pattern").isNull(), F.concat(F.lit(r"^(?:[^/]*\.)?"), _quoted(F.col("h")), _quoted(F.col("p")))
    ).otherwise(F.concat(F.lit("(?s)^"), any_of, F.lit("$")))
    # Whole tokens only: nothing that a wildcard, or the end of a prefix, may continue.
    whole = F.when(
        F.col("pattern").isNull(),
        F.concat(F.lit("."), F.col("h"), F.regexp_replace(F.concat(F.lit("/"), F.col("p")), f"{_TOKENS}$", "")),
    ).otherwise(F.regexp_replace(F.regexp_replace("pattern", rf"\*{_TOKENS}", "*"), rf"{_TOKENS}(?=\*)", ""))
    tokens = F.array_distinct(F.transform(F.regexp_extract_all(whole, F.lit(f"({_TOKENS})"), 1), F.lower))
    return listed.select(
        F.coalesce("pattern", F.concat("h", "p")).alias("rule"), "verdict", regex.alias("regex"), tokens.alias("tokens"),
        F.when(F.col("pattern").isNull(), F.length(F.concat("h", "p"))).otherwise(0).alias("length"),
    )


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, pattern for every row."""
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    words = F.array_distinct(F.transform(F.regexp_extract_all("url", F.lit(f"({_TOKENS})"), 1), F.lower))
    # A row without a token stands for the page itself. Rules without any whole token lie
    # under the empty one, which every URL asks for.
    base = F.array(F.lit(None).cast("string"), F.lit(""))
    asked = urls.select("page_id", "url", F.explode(F.concat(base, F.coalesce(words, F.array().cast("array<string>")))).alias("token"))
    listed = rules.select("*", F.explode_outer("tokens").alias("token"))
    # How many URLs hold each token that some rule has: sums over at most as many keys as rules have tokens.
    held = asked.join(listed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    best = (
        listed.join(held, "token", "left")
        .groupBy("rule", "verdict", "regex", "length")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), F.coalesce("token", F.lit("")).alias("token"))).alias("rarest"))
        .select("rule", "verdict", "regex", "length", F.col("rarest.token").alias("token"))
    )
    # A rule looks at host and path, which can't run into each other: a host holds no slash.
    seen = F.when(F.col("length") > 0, F.concat(host("url"), path("url"))).otherwise(F.col("url"))
    met = asked.join(best, "token", "left").where(F.col("token").isNull() | F.col("rule").isNotNull())
    rank = F.struct("length", F.when(F.col("verdict") == "block", 1).otherwise(0).alias("strict"), "rule", "verdict")
    won = met.groupBy("page_id", "url").agg(
        F.max(F.when(F.rlike(seen, F.col("regex")), rank)).alias("won"), F.count(F.when(F.col("token").isNull(), 1)).alias("rows")
    )
    ruled = F.col("won.length") > 0
    return won.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(
        "page_id", host("url").alias("host"), path("url").alias("path"),
        F.when(ruled, F.col("won.rule")).alias("rule"), F.coalesce("won.verdict", F.lit("allow")).alias("verdict"),
        F.when(~ruled, F.col("won.rule")).alias("pattern"),
    )


def query(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES, PATTERNS))


ORACLE = """
with split as (
  select page_id, url,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
), ruled as (
  select *, '.' || host as h,
    case when (h = '.www.example.com' or h like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
         when (h = '.example.com' or h like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
         when h like '%.net' and starts_with(path, '/es/') then 'net/es/'
         when h like '%.net' and starts_with(path, '/fr/') then 'net/fr/'
         when h like '%.com' and starts_with(path, '/') then 'com/' end as rule,
    case when url like '%?redirect=http%' then '*?redirect=http*'
         when url like '%://track.%' then '*://track.*'
         when url like '%://m.%/de/%' then '*://m.*/de/*'
         when url like '%://ads.%' then '*://ads.*'
         when url like '%/porn/%' then '*/porn/*'
         when url like '%/casino/%' then '*/casino/*' end as pat
  from split
)
select page_id, host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow'
            when rule is not null or pat is not null then 'block' else 'allow' end as verdict,
       case when rule is null then pat end as pattern
from ruled
"""
