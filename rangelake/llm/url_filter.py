"""URL filter: fixed host and path rules first, then association rules that FP-growth mines from labelled pages.

A URL is a set of tokens: the words of its host (``h:``) and path (``p:``), cut at dots, slashes, hyphens and underscores,
and the keys of its query (``q:``), lower-cased, each run of digits as ``#``. A labelled page is a transaction of its tokens
and its label, block (toxic, or of no quality) or allow. Spark's FP-growth finds the frequent combinations. A combination
is a rule if the pages that have it and are blocked reach SUPPORT of all labelled pages, if its confidence is LIFT times
the share of blocked pages at least, and if that isn't chance: the lower end of the confidence's Wilson interval (Z
deviations) is above that share. A rule goes if a part of it is a rule at least as sure. The same bounds hold at every size.

Rules are held in an inverted index under their rarest token: a URL meets only rules filed under a token that it has, and
a rule fits if the URL has all of its tokens. The index is broadcast if it has at most BROADCAST rules; a larger one is
joined by token, where Spark splits a hot one. A page that a fitting rule blocks is blocked, any other is allowed.

Defined cases: a URL that is null or lacks ``://`` has an empty host and path and no tokens, and is allowed. Repeated
rows are judged one by one. Labels without a page, and pages without a label, are no transactions; several labels of a
page are several transactions. No labels or no pages: no rules, so what no fixed rule fits is allowed. Other columns of
the tables are ignored. Whole transactions are mined: the time grows with the combinations that SUPPORT of the pages share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangelake.llm.shared import cut, shared_folder

#: Fixed rules: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT, LIFT, Z = 0.005, 1.5, 2.0
#: The most rules that are broadcast.
BROADCAST = 50_000
BLOCK, ALLOW = "label=block", "label=allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_RULES = "rarest string, tokens array<string>, confidence double, support double"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [(v, h + p, ((host == h) | host.endswith("." + h)) & path.startswith(p)) for v, h, p in ordered]
    name = reduce(lambda rest, r: F.when(r[2], F.lit(r[1])).otherwise(rest), reversed(fits), F.lit(None).cast("string"))
    verdict = reduce(lambda rest, r: F.when(r[2], F.lit(r[0])).otherwise(rest), reversed(fits), F.lit(None).cast("string"))
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1)

    def parts(text: Column, by: str, mark: str) -> Column:
        pieces = F.filter(F.split(F.lower(text), by), lambda x: x != "")
        return F.transform(pieces, lambda x: F.concat(F.lit(mark), F.regexp_replace(x if mark != "q:" else F.split(x, "=")[0], "[0-9]+", "#")))

    return F.array_distinct(F.concat(parts(host_of(url), "[._-]", "h:"), parts(path_of(url), "[/._-]", "p:"), parts(query, "&", "q:")))


def wilson_low(share: Column, n: Column, z: float = Z) -> Column:
    """Lower end of the Wilson interval of a share that n draws gave."""
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def meeting(have: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of ``have`` (with a column have) beside each rule whose tokens they all have."""
    met = have.withColumn("rarest", F.explode("have")).join(rules, "rarest")
    return met.filter(F.forall("tokens", lambda t: F.array_contains("have", t)))


def mine(pages: DataFrame, labels: DataFrame, folder: str, support: float = SUPPORT, lift: float = LIFT) -> DataFrame:
    """Rules: rarest (the token it is filed under), tokens, confidence, support."""
    spark = pages.sparkSession
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    tokens = pages.select(F.col("page_id").alias("doc_id"), tokens_of(F.col("url")).alias("tokens")).filter(F.size("tokens") > 0)
    labelled = cut(tokens.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("tokens", "bad"), "labelled", folder)
    rows, blocked = labelled.agg(F.count("*"), F.count(F.when(F.col("bad"), True))).first()
    if not blocked:
        return spark.createDataFrame([], NO_RULES)
    base = blocked / rows
    transactions = labelled.select(F.concat("tokens", F.array(F.when(F.col("bad"), BLOCK).otherwise(ALLOW))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min(1.0, lift * base)).fit(transactions)
    found = model.associationRules.filter((F.element_at("consequent", 1) == BLOCK) & ~F.array_contains("antecedent", ALLOW))
    found = found.filter((F.col("confidence") >= lift * base) & (wilson_low(F.col("confidence"), F.round(F.col("support") * rows / F.col("confidence"))) > base))
    found = cut(found.select(F.monotonically_increasing_id().alias("rule"), F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "found", folder)

    counts = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rarest = found.select("rule", F.explode("tokens").alias("token")).join(counts, "token").groupBy("rule").agg(F.min(F.struct("n", "token"))["token"].alias("rarest"))
    filed = cut(found.join(rarest, "rule"), "filed", folder)
    part = filed.select("rarest", F.col("tokens").alias("part"), F.col("confidence").alias("surety"))
    within = meeting(filed.select("rule", "confidence", F.col("tokens").alias("have")), part.withColumnRenamed("part", "tokens"))
    needless = within.filter((F.size("tokens") < F.size("have")) & (F.col("surety") >= F.col("confidence"))).select("rule").distinct()
    return filed.join(needless, "rule", "left_anti").select("rarest", "tokens", "confidence", "support")


def url_filter(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, lift: float = LIFT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, method_confidence (of the surest mined rule that fits)."""
    folder = shared_folder(pages.sparkSession)
    rules = cut(mine(pages, labels, folder, support, lift), "rules", folder).select("rarest", "tokens", "confidence")
    rules = F.broadcast(rules) if rules.count() <= BROADCAST else rules.hint("merge")
    url = F.col("url")
    host, path = host_of(url).alias("host"), path_of(url).alias("path")
    rows = pages.select("page_id", host, path, tokens_of(url).alias("have"), F.monotonically_increasing_id().alias("row"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    judged = rows.select("row", "page_id", "host", "path", rule.alias("rule"), verdict.alias("fixed"), "have")
    fits = meeting(judged.filter(F.col("rule").isNull()).select("row", "have"), rules).groupBy("row").agg(F.max("confidence").alias("method_confidence"))
    both = judged.drop("have").join(fits, "row", "left")
    chosen = F.coalesce(F.col("fixed"), F.when(F.col("method_confidence").isNotNull(), "block").otherwise("allow"))
    return both.select("page_id", "host", "path", "rule", chosen.alias("verdict"), "method_confidence")


_PIECES = "list_transform(list_filter(regexp_split_to_array(lower({0}), '{1}'), lambda x: x <> ''), lambda x: '{2}' || regexp_replace({3}, '[0-9]+', '#', 'g'))"
_FITS = "(host = '{1}' OR ends_with(host, '.{1}')) AND starts_with(path, '{2}')"
_ORDERED = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
#: Mines by all combinations of each page's tokens, so for small tables.
ORACLE_SQL = f"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*[^?#]*\\?([^#]*)', 1) AS query
  FROM pages),
split AS (
  SELECT *, row_number() OVER () AS page, list_distinct(list_concat(list_concat({_PIECES.format("host", "[._-]", "h:", "x")}, {_PIECES.format("path", "[/._-]", "p:", "x")}), {_PIECES.format("query", "&", "q:", "string_split(x, '=')[1]")})) AS have
  FROM cut),
labelled AS (
  SELECT have, (coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0)::INT AS bad
  FROM split JOIN labels ON page_id = doc_id WHERE len(have) > 0),
base AS (SELECT count(*) AS pages, sum(bad) / count(*) AS share FROM labelled),
combined AS (
  SELECT list_sort(list_filter(have, lambda x, i: (mask >> (i - 1)) & 1 = 1)) AS tokens, bad
  FROM (SELECT have, bad, unnest(range(1, (1 << len(have))::BIGINT)) AS mask FROM labelled)),
sure AS (SELECT tokens, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS b, sum(bad)::DOUBLE / count(*) AS p FROM combined GROUP BY tokens),
rules AS (
  SELECT tokens, p FROM sure, base
  WHERE b >= greatest(1, ceil({SUPPORT} * pages)) AND p >= {LIFT} * share
    AND (p + {Z * Z} / (2 * n) - {Z} * sqrt(p * (1 - p) / n + {Z * Z} / (4 * n * n))) / (1 + {Z * Z} / n) > share),
fixed AS (
  SELECT *, CASE {" ".join(f"WHEN {_FITS.format(*r)} THEN '{r[1]}{r[2]}'" for r in _ORDERED)} END AS rule,
    CASE {" ".join(f"WHEN {_FITS.format(*r)} THEN '{r[0]}'" for r in _ORDERED)} END AS verdict
  FROM split),
met AS (SELECT page, max(p) AS p FROM fixed JOIN rules ON list_has_all(have, tokens) WHERE rule IS NULL GROUP BY page)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN p IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, p AS method_confidence
FROM fixed LEFT JOIN met USING (page)
"""
