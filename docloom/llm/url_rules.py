"""URL filters by pattern rules that are indexed by their rarest literal token (operator 11).

A rule is an action (``allow`` or ``block``), a tier and a pattern over the url without its scheme, the host in lower case:
``||`` at the start stands for the host or any of its subdomains, ``*`` for any run of characters, ``^`` for a character
other than letters, digits and ``_ - . %``, or the end; ``|`` at the end for the end. Everything else is literal. Without
``||`` a pattern may start anywhere. Of the rules that fit a url the least tier decides, in it the longest pattern, of equal ones a block.

A rule's tokens are its literal runs of ``[a-z0-9]``, lower-cased, that have a boundary on either side in every url that fits
(so no run beside a ``*`` or an open end). The urls' tokens are counted, for the tokens of rules alone, and a rule is indexed by
the one that the fewest urls hold. Each distinct url looks its tokens up in the index, and only the rules found are run as regular expressions.
The index is joined, so the planner sends it to the urls if it is small and deals out both if it is not; a token that many urls
share is split as a skewed join. Rules without a token (``LOOSE`` of them at most, else a ValueError) are run on every url.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; urls that fit no rule have a
null rule and action; repeated rows get a row each, null ids and other columns pass through; empty tables give no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import LOWER, UPPER, ascii_lower
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

TOKEN = "[a-z0-9]+"
#: Rules without a token that may be run on every url.
LOOSE = 200

#: Rules of the contract: action, host and path.
BASE = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: The method's own rules: advertising, gambling and spam hosts, pages made for forms and machines, files that hold no text.
OWN = [("block", p) for p in """
||spam-farm. ||casino-win. ||cheap-pills. ||ads-track. ||doubleclick.net^ ||adserver. ||tracker. ||pixel. ||banner. ||popup.
/wp-admin/ /wp-login.php /cgi-bin/ /login^ /signin^ /signup^ /register^ /logout^ /cart^ /checkout^ /basket^ /captcha^
^sessionid= ^phpsessid= ^jsessionid= ^replytocom= ^add-to-cart= /tag/*/page/ /feed/*/feed/ /calendar/*/day/
.zip| .exe| .iso| .dmg| .apk| .torrent| .mp3| .mp4| .jpg| .png| .gif| viagra xxx-
""".split()] + [("allow", p) for p in "||docs.*/login^ ||wiki.*/register^ ||developer.*/checkout^".split()]


def expression(pattern: str) -> str:
    """The pattern as a regular expression that Java and RE2 read alike."""
    rest = pattern.removeprefix("||")
    end = rest.endswith("|")
    out = r"^(?:[^/?#]*\.)?" if pattern.startswith("||") else ""
    for c in rest.removesuffix("|"):
        out += {"*": r"[\s\S]*", "^": r"(?:[^A-Za-z0-9_.%-]|\z)"}.get(c) or (c if re.match(r"\w", c, re.ASCII) else f"[{c}]" if c not in "\\[]" else "\\" + c)
    return out + (r"\z" if end else "")


def tokens(pattern: str) -> list[str]:
    """The runs that every url which fits holds as whole tokens."""
    rest = pattern.removeprefix("||")
    # A control character stands for each place with no boundary, so that runs beside it can be told.
    open_start = "" if pattern.startswith("||") else "\0"
    text = open_start + rest.replace("*", "\0").removesuffix("|") + ("" if rest.endswith("|") else "\0")
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    return sorted({m[0] for m in re.finditer(TOKEN, lowered)
                   if lowered[max(0, m.start() - 1):m.start()] != "\0" and lowered[m.end():m.end() + 1] != "\0"})


def rule_table(spark: SparkSession, rules: list[tuple[str, int, str]]) -> DataFrame:
    """Rules (action, tier, pattern) as a table with regular expression and tokens; any table of these columns serves."""
    rows = [(a, t, p, expression(p), tokens(p)) for a, t, p in rules]
    return spark.createDataFrame(rows, "action string, tier int, pattern string, expression string, tokens array<string>")


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and the url from its host on."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    raw = F.regexp_extract(after, "^[^/?#]*", 0)
    rest = F.substring(after, F.length(raw) + 1, F.greatest(F.length(after), F.lit(1)))
    return ascii_lower(raw), F.regexp_extract(rest, "^[^?#]*", 0), F.concat(ascii_lower(raw), rest)


def token_rows(urls: DataFrame) -> DataFrame:
    """(url, line, token) of distinct urls, each token once."""
    found = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("line")), F.lit(TOKEN), F.lit(0)))
    return urls.select("url", "line", F.explode(found).alias("token"))


def rarest_tokens(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The index: each rule that has tokens under the one that the fewest urls hold, with that number."""
    own = rules.select("*", F.explode("tokens").alias("token")).drop("tokens")
    wanted = own.select("token").distinct()
    held = token_rows(urls).join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n_urls"))
    own = own.join(held, "token", "left").withColumn("n_urls", F.coalesce("n_urls", F.lit(0)))
    least = F.min(F.struct("n_urls", "token")).alias("least")
    return own.groupBy("action", "tier", "pattern", "expression").agg(least).select(
        "action", "tier", "pattern", "expression", "least.token", "least.n_urls")


def rank(action: Column, tier: Column, pattern: Column) -> Column:
    """What the deciding rule has least of."""
    return F.struct(tier.alias("tier"), (-F.length(pattern)).alias("length"), (action != "block").alias("allows"), pattern.alias("pattern"), action.alias("action"))


ADDED = ["rule_host", "rule_path", "rule_tier", "rule_pattern", "rule_action"]


def judge(table: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of ``table`` with the columns ``ADDED``, in place of any of these names."""
    # Written, so that the planner knows its size.
    rules = materialise(rules, "rules")
    loose = rules.filter(F.size("tokens") == 0).limit(LOOSE + 1).collect()
    if len(loose) > LOOSE:
        raise ValueError(f"more than {LOOSE} rules without a literal token")
    urls = table.select(F.col(url).alias("url")).filter(F.contains(F.col("url"), F.lit("://"))).distinct()
    urls = materialise(urls.select("url", parts(F.col("url"))[2].alias("line")), "distinct-urls")
    index = materialise(rarest_tokens(urls, rules), "rule-index")
    fits = token_rows(urls).join(index, "token").filter(F.expr("line RLIKE expression"))
    fits = fits.select("url", rank(F.col("action"), F.col("tier"), F.col("pattern")).alias("rank"))
    if loose:
        each = F.array(*[F.when(F.col("line").rlike(r["expression"]), rank(F.lit(r["action"]), F.lit(r["tier"]), F.lit(r["pattern"]))) for r in loose])
        fits = fits.union(urls.select("url", F.explode(F.filter(each, lambda r: r.isNotNull())).alias("rank")))
    best = fits.groupBy("url").agg(F.min("rank").alias("__rank")).withColumnRenamed("url", "__url")
    host, path, _ = parts(F.col(url))
    rows = table.select(*[c for c in table.columns if c not in ADDED], host.alias("rule_host"), path.alias("rule_path"))
    out = rows.join(best, F.col(url) == F.col("__url"), "left")
    return out.select(*rows.columns, F.col("__rank.tier").alias("rule_tier"), F.col("__rank.pattern").alias("rule_pattern"),
                      F.col("__rank.action").alias("rule_action"))


def production_rules() -> list[tuple[str, int, str]]:
    return [(a, 0, "||" + p) for a, p in BASE] + [(a, 1, p) for a, p in OWN]


def values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


ORACLE = f"""WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u FROM pages),
q AS (SELECT page_id, regexp_extract(u, '^[^/?#]*') AS h, substr(u, length(regexp_extract(u, '^[^/?#]*')) + 1) AS t
  FROM (SELECT page_id, coalesce(u, '') AS u FROM p)),
s AS (SELECT row_number() OVER () AS k, page_id, translate(h, '{UPPER}', '{LOWER}') AS host, regexp_extract(t, '^[^?#]*') AS path,
  translate(h, '{UPPER}', '{LOWER}') || t AS line FROM q),
b AS (SELECT k, arg_max(name, length(name)) AS rule, arg_max(action, length(name)) AS verdict FROM s,
  (VALUES {values((a, p, p[:p.index("/")], p[p.index("/"):]) for a, p in BASE)}) AS r(action, name, host_of, path_of)
  WHERE (host = host_of OR ends_with(host, '.' || host_of)) AND starts_with(path, path_of) GROUP BY k),
o AS (SELECT k, arg_min(pattern, (-length(pattern), action <> 'block', pattern)) AS own_rule,
  arg_min(action, (-length(pattern), action <> 'block', pattern)) AS verdict FROM s,
  (VALUES {values((a, p, expression(p)) for a, p in OWN)}) AS r(action, pattern, expression)
  WHERE regexp_matches(line, expression) GROUP BY k)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN own_rule END AS own_rule, coalesce(b.verdict, o.verdict, 'allow') AS verdict
FROM s LEFT JOIN b USING (k) LEFT JOIN o USING (k)"""


@query("op11_url_rules", ORACLE)
def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(load(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark, production_rules()))
    base = F.col("rule_tier") == 0
    return judged.select(
        "page_id", F.col("rule_host").alias("host"), F.col("rule_path").alias("path"),
        F.when(base, F.substr(F.col("rule_pattern"), F.lit(3))).alias("rule"), F.when(~base, F.col("rule_pattern")).alias("own_rule"),
        F.coalesce("rule_action", F.lit("allow")).alias("verdict"))
