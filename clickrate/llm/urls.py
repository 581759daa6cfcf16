"""URL rules by a sort-merge range join, in DataFrame functions only.

A rule is a host and a path prefix; it fits its host and all subdomains.  The canonical key
of a rule is its host's labels in reverse and its path: every url it fits has, for the part
of its own host that equals the rule's, a key that starts with it.  Keys are compared as their
UTF-8 bytes, none of which is FF: so a rule is the interval from its key up to the key followed
by that byte, whatever characters a path goes on with, and such intervals nest.

Rule starts, rule ends and url keys (one for each suffix of the url's host that is some rule's
host, and one for the whole host) are sorted together within (host suffix, salt).  A start makes its rule the innermost active one, an
end gives that place back to the rule around it, and each url takes the innermost active
rule it meets: the running last value is the top of the stack of active nested rules.
The rule around a rule is found by an equality join on its own prefixes, so the state kept
for each place is one rule, however many are nested.  A url's answer is the longest rule
over the suffixes of its host.

Urls are dealt over the salts of each host suffix, to each of which the (few) rules of that
suffix are copied: a host with a third of all urls has its rows in as many groups.  There is
a salt for every SALT_ROWS pages, and SALTS at least, so a group does not grow with the table.

Defined results: null urls and urls without ``://``: empty host and path, no rule, the
default verdict.  Rules with a null or empty host or path never fit; of equal rules the
smallest verdict counts (allow before block).  An empty page table gives no rows.  Repeated
pages each get a row, null ids as well.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from clickrate.llm.common import stored, table

SALTS, SALT_ROWS = 64, 1_000_000
#: Host, path, verdict of the production rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_BEHIND = b"\xff"


def _lower(c):
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every page."""
    rest = F.when(F.locate("://", F.col("url")) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    cut = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    return cut.select("page_id", _lower(host).alias("host"), F.regexp_extract(F.expr("substring(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1)"), r"^[^?#]*", 0).alias("path"))


def _suffixes(host):
    """Every suffix of a host that begins at a label, the whole one first: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def _key(host, path):
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("\x01"), path), "UTF-8")


def rule_events(rules: DataFrame) -> DataFrame:
    """suffix, at, closing, top: where each rule starts and ends, and the rule active from there on."""
    r = (rules.filter("host <> '' and path <> ''").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
         .select("host", "path", _key(F.col("host"), F.col("path")).alias("key"), F.struct(F.concat("host", "path").alias("rule"), "verdict").alias("me")))
    outer = r.select("host", "path", F.col("me").alias("around"))
    inner = r.select("host", "key", F.explode(F.sequence(F.lit(1), F.length("path"))).alias("n"), F.expr("substring(path, 1, n - 1)").alias("path"))
    parent = inner.join(outer, ["host", "path"]).groupBy("key").agg(F.max_by("around", "n").alias("around"))
    both = r.join(parent, "key", "left")
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return (both.select(F.col("host").alias("suffix"), F.col("key").alias("at"), F.lit(0).alias("turn"), F.col("me").alias("top"))
            .union(both.select("host", F.concat("key", F.lit(_BEHIND)), F.lit(0), F.coalesce("around", none))))


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    salts = max(SALTS, -(-pages.count() // SALT_ROWS))
    rules = stored(pages.sparkSession, rules.select("host", "path", "verdict"), "url-rules")  # of known size: a small one is sent to the tasks, a large one shuffled
    ruled = rules.select(F.col("host").alias("suffix")).distinct().withColumn("ruled", F.lit(True))
    rows = parts(pages).withColumn("row", F.monotonically_increasing_id())
    url = (rows.select("*", F.posexplode(_suffixes(F.col("host"))).alias("i", "suffix"))
           .join(ruled, "suffix", "left").filter("i = 0 or ruled")
           .select("row", "page_id", "host", "path", "suffix", _key(F.col("suffix"), F.col("path")).alias("at"), F.lit(1).alias("turn"),
                   F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("top")))
    rule = rule_events(rules).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    events = url.unionByName(rule, allowMissingColumns=True)
    sweep = W.partitionBy("suffix", "salt").orderBy("at", "turn").rowsBetween(W.unboundedPreceding, W.currentRow)
    met = events.withColumn("met", F.last("top", ignorenulls=True).over(sweep)).filter("row is not null")
    best = F.max(F.when(F.col("met.rule").isNotNull(), F.struct(F.length("met.rule").alias("n"), F.col("met.rule").alias("rule"), F.col("met.verdict").alias("verdict"))))
    return (met.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    text = T.StringType()
    return spark.createDataFrame(rules, T.StructType([T.StructField(c, text) for c in ("host", "path", "verdict")]))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production rules over all ``pages``; urls without a rule are allowed."""
    return judged(table(spark, sf_dir, "pages"), rule_table(spark))


OP6_SQL = r"""
WITH c AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM c),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
