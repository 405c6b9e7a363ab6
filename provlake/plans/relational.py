"""Catalog queries: keys, joins, aggregates and windows on the shared tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provlake.operators import aggregate as agg
from provlake.operators import dataset as ds
from provlake.operators import keys, split
from provlake.sources.search import keyset_page

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def cents(c):
    return F.round(c * 100).cast("long")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) rn FROM events) WHERE rn = 1")
def newest_per_concept(t):
    return keys.newest_per_key(t("events").select("user_id", "event_id", "event_type"), "user_id", F.col("event_id"), "event_id")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def first_seen(t):
    return keys.first_seen(t("events").select("user_id", "event_type", "event_id").withColumn("k", F.struct("user_id", "event_type")), "k", "event_id").drop("k")


@query("""SELECT gate, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN l.toxic <> 0 THEN 'toxic' WHEN l.quality <> 1 THEN 'low_quality' ELSE 'keep' END AS gate
 FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY 1""")
def gate_accounting(t):
    j = t("documents").select("doc_id").join(t("labels").withColumn("has", F.lit(True)), "doc_id", "left")
    return agg.gate_counts(j, [("unlabelled", F.col("has")), ("toxic", F.col("toxic") == 0), ("low_quality", F.col("quality") == 1)])


@query("SELECT lang, count(*) AS n FROM documents WHERE regexp_matches(lower(text), 'licen[cs]e|copyright|rights reserved') GROUP BY 1")
def licence_signal(t):
    return t("documents").where(F.lower("text").rlike("licen[cs]e|copyright|rights reserved")).groupBy("lang").agg(F.count("*").alias("n"))


@query("""SELECT category, rank, count(*) AS n FROM (SELECT CASE WHEN n_chars > 5000 THEN 'long' WHEN regexp_matches(text, '[0-9]{6}') THEN 'numeric' WHEN text LIKE '%.%' THEN 'prose' ELSE 'other' END AS category,
 CASE WHEN n_chars > 5000 THEN 3 WHEN regexp_matches(text, '[0-9]{6}') THEN 2 WHEN text LIKE '%.%' THEN 1 ELSE 0 END AS rank FROM documents) GROUP BY 1, 2""")
def category_histogram(t):
    long, num, prose = F.col("n_chars") > 5000, F.col("text").rlike("[0-9]{6}"), F.col("text").contains(".")
    kind = lambda name, rank: F.struct(F.lit(name).alias("category"), F.lit(rank).alias("rank"))
    c = F.when(long, kind("long", 3)).when(num, kind("numeric", 2)).when(prose, kind("prose", 1)).otherwise(kind("other", 0))
    return t("documents").select(c.alias("c")).groupBy("c.category", "c.rank").agg(F.count("*").alias("n"))


@query("""SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, lower(regexp_extract(url, '(\\.[a-z]+)([?#].*)?$', 1)) AS ext, contains(url, '?') AS has_query, count(*) AS n FROM pages GROUP BY 1, 2, 3""")
def url_classes(t):
    u = F.col("url")
    return t("pages").groupBy(F.regexp_extract(u, "://([^/?#]*)", 1).alias("host"), F.lower(F.regexp_extract(u, r"(\.[a-z]+)([?#].*)?$", 1)).alias("ext"), u.contains("?").alias("has_query")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def resume_anti(t):
    return keys.remaining(t("orders").select(F.col("o_orderkey").alias("k")), t("lineitem").select(F.col("l_orderkey").alias("k")), "k").select(F.col("k").alias("o_orderkey"))


@query("SELECT lang, count(*) AS kept, sum(n_chars)::BIGINT AS chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1")
def keep_semi(t):
    return t("documents").select("doc_id", "lang", "n_chars").join(t("labels"), "doc_id", "left_semi").groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_chars").alias("chars"))


@query("""SELECT doc_id, side FROM (SELECT doc_id, 'left_only' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right_only' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))""")
def map_completeness(t):
    return keys.completeness(t("documents"), t("labels"), "doc_id")


@query("""SELECT coalesce(k1, k2) AS k, coalesce(a, 0) AS in_meta, coalesce(b, 0) AS on_disk, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'orphan' WHEN b > 1 THEN 'duplicate_on_disk' ELSE 'duplicate_in_meta' END AS state FROM
 (SELECT o_orderkey k1, count(*) a FROM orders GROUP BY 1) FULL JOIN (SELECT l_orderkey k2, count(*) b FROM lineitem GROUP BY 1) ON k1 = k2 WHERE a IS NULL OR b IS NULL OR a > 1 OR b > 1""")
def bijection(t):
    return ds.bijection(t("orders").select(F.col("o_orderkey").alias("k")), t("lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_ids(t):
    return keys.duplicate_keys(t("lineitem"), "l_orderkey", "l_linenumber")


@query("""SELECT o_orderkey, CASE WHEN m.k IS NOT NULL AND o_orderstatus = 'O' THEN 'S' ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN (SELECT l_orderkey AS k FROM lineitem GROUP BY 1 HAVING max(l_shipdate) >= TIMESTAMP '1997-01-01') m ON m.k = o_orderkey""")
def upsert_map(t):
    new = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("d")).where("d >= timestamp'1997-01-01'").select("o_orderkey", F.lit("S").alias("o_orderstatus"))
    return keys.upsert(t("orders").select("o_orderkey", "o_orderstatus"), new, "o_orderkey", ["o_orderstatus"], F.col("o_orderstatus") == "O")


@query("SELECT coalesce(o_orderpriority, 'null') AS k, sum(n)::BIGINT AS weight, count(*) AS n FROM orders JOIN (SELECT l_orderkey, count(*) n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1")
def weighted_counts(t):
    per = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("w"))
    return agg.weighted_counts(t("orders").select("o_orderkey", "o_orderpriority").join(per, F.col("o_orderkey") == F.col("l_orderkey")), F.col("o_orderpriority"), F.col("w"), "k")


@query("SELECT count(*) FILTER (quality = 1) AS yes, count(*) FILTER (quality <> 1) AS no, count(*) FILTER (quality IS NULL) AS unknown FROM documents LEFT JOIN labels USING (doc_id)")
def three_state(t):
    return agg.three_state(t("documents").select("doc_id").join(t("labels"), "doc_id", "left"), F.col("quality") == 1)


@query("SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents) GROUP BY 1 HAVING count(*) >= 20")
def set_membership_counts(t):
    return agg.membership_counts(t("documents").select("text"), F.split(F.lower("text"), " "), "word").where("n >= 20")


@query("SELECT lang, cap, count(*) FILTER (cap < 0 OR n_chars <= cap) AS n, coalesce(sum(n_chars) FILTER (cap < 0 OR n_chars <= cap), 0)::BIGINT AS bytes FROM documents, (SELECT unnest([100, 1000, 10000, -1])::BIGINT AS cap) GROUP BY 1, 2")
def cap_sweep(t):
    return agg.cap_sweep(t("documents"), "lang", "n_chars", [100, 1000, 10000, None])


@query("""SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS total, round(avg(n_chars), 2) AS mean, min(n_chars) AS low, max(n_chars) AS high,
 list_sort(list(n_chars))[(count(*) // 2)::INT + 1] AS median, list_sort(list(n_chars))[least(count(*) - 1, floor(0.9 * count(*))::INT)::INT + 1] AS p90 FROM documents GROUP BY 1""")
def lower_index_stats(t):
    return agg.lower_index_stats(t("documents"), "lang", "n_chars")


@query("""WITH c AS (SELECT o_custkey, sum(round(o_totalprice * 100)::BIGINT) v FROM orders GROUP BY 1), r AS (SELECT v, row_number() OVER (ORDER BY v DESC, o_custkey) rn FROM c)
SELECT top, round(sum(v)::DOUBLE / (SELECT sum(v) FROM c), 6) AS share FROM r, (SELECT unnest([1, 3, 10])::INT AS top) WHERE rn <= top GROUP BY 1""")
def concentration(t):
    return agg.concentration(t("orders"), "o_custkey", cents(F.col("o_totalprice")), [1, 3, 10])


@query("SELECT CASE WHEN n_chars <= 500 THEN '<=500' WHEN n_chars <= 2000 THEN '501-2000' WHEN n_chars <= 8000 THEN '2001-8000' ELSE '>8000' END AS bucket, count(*) AS n, sum(n_chars)::BIGINT AS weight FROM documents GROUP BY 1")
def size_buckets(t):
    return agg.buckets(t("documents"), "n_chars", [500, 2000, 8000])


@query("""SELECT source, field, n, filled, round(100.0 * filled / n, 2) AS percent FROM (SELECT source, count(*) AS n, count(*) FILTER (text <> '') AS text, count(*) FILTER (lang <> '') AS lang, count(n_chars) AS n_chars FROM documents GROUP BY 1)
UNPIVOT (filled FOR field IN (text, lang, n_chars))""")
def presence_matrix(t):
    return agg.presence(t("documents"), "source", ["text", "lang", "n_chars"])


@query("""WITH p AS (SELECT event_type, user_id, count(*) n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) k FROM p)
SELECT event_type, sum(n)::BIGINT AS total, count(*) AS ids, (sum(n) FILTER (k <= 5))::BIGINT AS top FROM r GROUP BY 1""")
def rejection_breakdown(t):
    return agg.top_share(t("events"), "event_type", "user_id", 5)


@query("""SELECT k.n AS keep, a.n AS attempted, d.n AS done, k.n - a.n AS untouched, round(100.0 * a.n / k.n, 1) AS percent FROM (SELECT count(*) n FROM orders) k, (SELECT count(DISTINCT l_orderkey) n FROM lineitem) a,
 (SELECT count(*) n FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)) d""")
def status_row(t):
    from provlake.functions.records import percent

    o = t("orders").select("o_orderkey", "o_orderstatus").join(t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.lit(1).alias("hit")), "o_orderkey", "left")
    row = o.agg(F.count("*").alias("keep"), F.count("hit").alias("attempted"), F.count_if(F.col("hit").isNotNull() & (F.col("o_orderstatus") == "F")).alias("done"))
    return row.select("keep", "attempted", "done", (F.col("keep") - F.col("attempted")).alias("untouched"), percent(F.col("attempted"), F.col("keep")).alias("percent"))


@query("""SELECT count(*) AS orders, count(*) FILTER (n > 0) AS with_lines, count(*) FILTER (r > 0) AS returned, count(*) FILTER (n IS NULL) AS without, count(*) = count(*) FILTER (n > 0) + count(*) FILTER (n IS NULL) AS holds
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) n, count(*) FILTER (l_returnflag = 'R') r FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def funnel(t):
    per = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    row = t("orders").select("o_orderkey").join(per, "o_orderkey", "left").agg(F.count("*").alias("orders"), F.count_if(F.col("n") > 0).alias("with_lines"), F.count_if(F.col("r") > 0).alias("returned"), F.count_if(F.col("n").isNull()).alias("without"))
    return row.withColumn("holds", F.col("orders") == F.col("with_lines") + F.col("without"))


@query("SELECT part, count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS weight FROM (SELECT o_totalprice, ((row_number() OVER (ORDER BY o_orderkey) - 1) % 7)::INT AS part FROM orders) GROUP BY 1")
def round_robin(t):
    p = split.positions(t("orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    return split.round_robin(p, "position", 7).groupBy("part").agg(F.count("*").alias("n"), F.sum(cents(F.col("o_totalprice"))).alias("weight"))


@query("""WITH RECURSIVE g AS (SELECT o_custkey, count(*) w, row_number() OVER (ORDER BY count(*) DESC, o_custkey) i FROM orders GROUP BY 1),
r AS (SELECT 0::BIGINT AS i, [0, 0, 0, 0]::BIGINT[] AS load, NULL::BIGINT AS k, NULL::BIGINT AS w, NULL::INT AS part UNION ALL
 SELECT g.i, list_transform(r.load, lambda x, j: CASE WHEN j = list_position(r.load, list_min(r.load)) THEN x + g.w ELSE x END), g.o_custkey, g.w, list_position(r.load, list_min(r.load)) - 1 FROM r JOIN g ON g.i = r.i + 1)
SELECT k AS o_custkey, w AS weight, part FROM r WHERE k IS NOT NULL""")
def lpt_parts(t):
    g = t("orders").groupBy("o_custkey").agg(F.count("*").alias("weight"))
    return split.lpt(g, "o_custkey", "weight", 4)


@query("""WITH p AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
SELECT doc_id, n_chars FROM p WHERE i IN (SELECT floor(j * n / 20.0)::BIGINT FROM (SELECT unnest(range(20)) AS j), (SELECT count(*) AS n FROM documents))""")
def even_stride(t):
    return split.even_stride(t("documents").select("doc_id", "n_chars"), ["n_chars", "doc_id"], 20)


@query("""SELECT doc_id, n_chars, running FROM (SELECT doc_id, n_chars, (sum(n_chars) OVER (ORDER BY n_chars, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS running, row_number() OVER (ORDER BY n_chars, doc_id) rn FROM documents) WHERE running <= 100000 OR rn = 1""")
def budget_prefix(t):
    return split.budget_prefix(t("documents").select("doc_id", "n_chars"), ["n_chars", "doc_id"], "n_chars", 100_000).select("doc_id", "n_chars", "running")


@query("""WITH RECURSIVE o AS (SELECT doc_id, n_chars::BIGINT AS b, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
r AS (SELECT 0::BIGINT AS i, 0::BIGINT AS used, 0::BIGINT AS files, NULL::BIGINT AS doc_id, NULL::VARCHAR AS decision UNION ALL
 SELECT o.i, CASE WHEN b <= 200000 AND used + b <= 200000 AND files < 500 THEN used + b ELSE used END, CASE WHEN b <= 200000 AND used + b <= 200000 AND files < 500 THEN files + 1 ELSE files END, o.doc_id,
 CASE WHEN b > 200000 THEN 'never_fits' WHEN used + b > 200000 OR files >= 500 THEN 'defer' ELSE 'fits' END FROM r JOIN o ON o.i = r.i + 1)
SELECT doc_id::VARCHAR AS id, doc_id AS pos, decision FROM r WHERE i > 0""")
def budget_admit(t):
    d = t("documents").select("doc_id", "n_chars", F.lit(1).alias("files"))
    return split.admit(d, "doc_id", "doc_id", "n_chars", "files", 200_000, 500)


@query("""WITH RECURSIVE e AS (SELECT floor(epoch(ts))::BIGINT AS s FROM events), r AS (SELECT min(s) AS a, max(s) + 1 AS b, count(*) AS n FROM e UNION ALL
 SELECT h.a, h.b, count(s) FROM (SELECT unnest([{'a': a, 'b': (a + b) // 2}, {'a': (a + b) // 2, 'b': b}]) AS h FROM r WHERE n > 1000 AND b - a > 1) LEFT JOIN e ON s >= h.a AND s < h.b GROUP BY 1, 2)
SELECT a AS start, b AS stop, n FROM r WHERE n <= 1000 OR b - a <= 1""")
def time_bisect(t):
    df = t("events").select("ts")
    return df.sparkSession.createDataFrame(split.time_ranges(df, "ts", 1000), "start long, stop long, n long")


@query("SELECT event_id, user_id FROM events WHERE event_id > 5000 ORDER BY event_id LIMIT 100")
def keyset_page_query(t):
    return keyset_page(t("events").select("event_id", "user_id"), "event_id", 5000, 100)


@query("SELECT page_id, regexp_extract(html, 'href=\"(/[^\"]*)\"', 1) AS link FROM pages WHERE regexp_extract(html, 'href=\"(/[^\"]*)\"', 1) <> ''")
def link_extract(t):
    link = F.regexp_extract("html", 'href="(/[^"]*)"', 1)
    return t("pages").select("page_id", link.alias("link")).where("link <> ''")


@query("SELECT (TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) // 10) AS bucket, count(*) AS n FROM events GROUP BY 1")
def json_props(t):
    return t("events").groupBy(F.floor(F.get_json_object("props", "$.k").try_cast("long") / 10).cast("long").alias("bucket")).agg(F.count("*").alias("n"))


@query("""SELECT event_id, prev FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type <> 'purchase' THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM events) WHERE event_type = 'purchase'""")
def carry_forward(t):
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, -1)
    prev = F.last(F.when(F.col("event_type") != "purchase", F.col("event_type")), ignorenulls=True).over(w)
    return t("events").select("event_id", "event_type", prev.alias("prev")).where("event_type = 'purchase'").select("event_id", "prev")


@query("SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY 1")
def last_of_sequence(t):
    c = t("conversations").where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("r"))
    return c.select("conv_id", "r.turn", "r.text")


@query("""SELECT source, sha1(string_agg(h, '' ORDER BY block)) AS print, sum(n)::BIGINT AS n FROM (SELECT source, doc_id // 1000 AS block, sha1(string_agg(sha1(text), '' ORDER BY doc_id)) AS h, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1""")
def fingerprint(t):
    # a tree of ordered hashes: a task holds the hashes of one block of ids, then one hash per block
    joined = lambda a: F.sha1(F.array_join(F.transform(F.array_sort(a), lambda x: x["h"]), ""))
    d = t("documents").select("source", F.floor(F.col("doc_id") / 1000).alias("block"), F.struct("doc_id", F.sha1("text").alias("h")).alias("x"))
    blocks = d.groupBy("source", "block").agg(joined(F.collect_list("x")).alias("h"), F.count("*").alias("n"))
    return blocks.groupBy("source").agg(joined(F.collect_list(F.struct("block", "h"))).alias("print"), F.sum("n").alias("n"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS norm FROM embeddings")
def vector_norm(t):
    return t("embeddings").select("vec_id", F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), 4).alias("norm"))


@query("""SELECT change, count(*) AS n FROM (SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) || ' -> ' || event_type AS change, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) <> event_type AS moved FROM events) WHERE moved GROUP BY 1""")
def transitions(t):
    w = W.partitionBy("user_id").orderBy("event_id")
    e = t("events").select("event_type", F.lag("event_type").over(w).alias("old")).where("old is not null")
    return agg.transitions(e, F.col("old"), F.col("event_type"))


@query("SELECT count(DISTINCT source) AS source, count(DISTINCT lang) AS lang, count(DISTINCT text) AS text FROM documents")
def distinct_counts(t):
    return agg.distinct_counts(t("documents"), ["source", "lang", "text"])


@query("""WITH w AS (SELECT CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 25 THEN 1 WHEN l_quantity < 40 THEN 2 ELSE 3 END AS bucket, round(l_extendedprice * 100)::BIGINT AS c FROM lineitem)
SELECT bucket, round(sum(c)::DOUBLE / (SELECT sum(c) FROM w), 6) AS share FROM w GROUP BY 1""")
def weighted_histogram(t):
    return agg.weighted_histogram(t("lineitem").select("l_quantity", cents(F.col("l_extendedprice")).alias("c")), "l_quantity", "c", [10, 25, 40])


@query("""WITH f AS (SELECT user_id, event_id, event_type = 'error' AS bad, sum(CASE WHEN event_type <> 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS isl, event_type = 'click' AS failed FROM events),
s AS (SELECT user_id, event_id, sum(failed::INT) OVER (PARTITION BY user_id, isl ORDER BY event_id) AS streak FROM f) SELECT user_id, min(event_id) AS event_id FROM s WHERE streak = 3 GROUP BY 1""")
def failure_streak(t):
    return split.streaks(t("events").select("user_id", "event_id", (F.col("event_type") == "click").alias("failed")), "user_id", "event_id", "failed", 3)


@query("""SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE n <= 5 OR i IN (0, round_even((n - 1) / 4.0, 0)::BIGINT, round_even(2 * (n - 1) / 4.0, 0)::BIGINT, round_even(3 * (n - 1) / 4.0, 0)::BIGINT, n - 1)""")
def stratified_spread(t):
    return split.stratified_spread(t("events").select("event_type", "event_id"), "event_type", "event_id", 5)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents, round(avg(l_discount), 6) AS disc FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def pricing_summary(t):
    li = t("lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02 00:00:00'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(cents(F.col("l_extendedprice"))).alias("cents"), F.round(F.avg("l_discount"), 6).alias("disc"))

