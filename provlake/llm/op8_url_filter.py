"""URL filters: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

Only DataFrame functions are used.  A page's URL stands for the canonical keys that could be listed:
every domain its host lies in, joined with the beginning of its path at every listed length.  Each key
is tested against the filter (one 64-bit block per key, K bits in it); keys that pass go to an exact
join with the list, and the longest listed key of a page decides.

Rules are a small table (checked: RULE_LIMIT); the filter is an array literal of at most BLOCK_LIMIT
64-bit blocks.  Beyond RULE_LIMIT rules the exact join isn't broadcast but shuffled.  Defined cases:
null URLs and ones without ``://`` have an empty host and path and no rule; pages that repeat come back
as often as they came; no rules at all leave every page to the default verdict, as does an unlisted URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm.common import table

#: Fixed values of the contract: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
DEFAULT = "allow"
RULE_LIMIT, BLOCK_LIMIT, BITS_PER_KEY, K = 100_000, 1 << 16, 16, 4


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` with A-Z lower-cased, path up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> Column:
    """K bits of a 64-bit block, from one hash."""
    h, out = F.xxhash64(key, F.lit(1)), None
    for i in range(K):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def build_filter(keys: DataFrame) -> list[int]:
    """Blocks of the filter of ``keys`` (key: string), merged before they reach the driver: BLOCK_LIMIT at most."""
    n = keys.count()
    blocks = max(1, min(BLOCK_LIMIT, -(-n * BITS_PER_KEY // 64)))
    rows = keys.groupBy(_block(F.col("key"), blocks).alias("b")).agg(F.bit_or(_bits(F.col("key"))).alias("w")).collect()
    out = [0] * blocks
    for r in rows:
        out[r.b] = r.w
    return out


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict; ``rules`` has host, path, verdict (each host and path once)."""
    rules = rules.select(F.concat("host", "path").alias("key"), F.col("verdict").alias("listed"), F.length("path").alias("size"))
    sizes = [r.size for r in rules.select("size").distinct().limit(1001).collect()]
    if len(sizes) > 1000:
        raise ValueError("more than 1000 different path lengths are listed")
    words = build_filter(rules)
    host, path = url_parts(F.col("url").cast("string"))
    base = pages.select("page_id", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tails = F.array_distinct(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(sizes)] or [F.lit(None).cast("string")]))
    # an empty host is in no listed domain
    keys = F.when(F.col("host") != "", F.flatten(F.transform(domains, lambda d: F.transform(F.filter(tails, lambda t: t.isNotNull()), lambda t: F.concat(d, t)))))
    table_ = F.array(*[F.lit(w).cast("long") for w in words])

    def passes(key: Column) -> Column:
        want = _bits(key)
        return F.get(table_, _block(key, len(words))).bitwiseAND(want) == want

    tested = base.withColumn("hits", F.filter(F.coalesce(keys, F.array().cast("array<string>")), passes))
    none = tested.where(F.size("hits") == 0).select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    some = tested.where(F.size("hits") > 0).select("page_id", "host", "path", F.posexplode("hits").alias("n", "key"))
    listed = rules if rules.count() > RULE_LIMIT else F.broadcast(rules)
    best = some.join(listed, "key", "left").groupBy("page_id", "host", "path").agg(
        F.max(F.when(F.col("listed").isNotNull(), F.struct(F.length("key").alias("n"), "key", "listed"))).alias("r"), F.count_if(F.col("n") == 0).alias("rows")
    )
    # rows that repeat were counted by their first key; each comes back
    best = best.select("page_id", "host", "path", "r", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_"))
    best = best.select("page_id", "host", "path", F.col("r.key").alias("rule"), F.coalesce("r.listed", F.lit(default)).alias("verdict"))
    return none.unionByName(best)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


ORACLE = """
WITH r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest, row_number() OVER () AS n FROM pages),
p AS (SELECT n, page_id,
  coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
m AS (SELECT p.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.n)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (n)
"""
