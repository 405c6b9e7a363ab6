"""Catalog queries: record stages, units, repair, samples, texts and quantities, each through its library operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import files, headers, physics, records
from provlake.operators import aggregate as agg
from provlake.operators import dataset as ds
from provlake.operators import fetch, keys, report, sample, scf, split
from provlake.plans.relational import ORACLES as _SQL
from provlake.plans.relational import QUERIES as _ALL
from provlake.plans.relational import query
from provlake.plans.rules import at, name_of, sql_at, sql_name

S = "string"


def text(*parts):
    """Literal texts and columns as one text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast(S) for p in parts])


# --- records ----------------------------------------------------------------------------


@query(f"""SELECT o_orderkey::VARCHAR AS recid, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR ELSE 'c' || (o_orderkey % 40) END AS concept, 2 AS files_total, (o_custkey + CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 0 END)::BIGINT AS bytes_total,
 CASE WHEN o_orderkey % 2 = 0 THEN 'dft,vasp' ELSE '' END AS signals, CASE WHEN o_orderkey % 5 <> 0 THEN 'cc-by-4.0' END AS license FROM orders""")
def normal_hits(t):
    k = F.col("o_orderkey")
    link = F.struct(F.lit("u").alias("self"))
    f = lambda key, size: F.struct(F.lit(key).alias("key"), size.cast("long").alias("size"), F.lit("md5").alias("checksum"), link.alias("links"))
    title = F.when(k % 2 == 0, "VASP study, a vasp run").otherwise("Birds")
    meta = F.struct(
        title.alias("title"), F.struct(F.lit("dataset").alias("type")).alias("resource_type"), F.array(F.struct(F.lit("A").alias("name"))).alias("creators"), F.when(k % 2 == 0, F.array(F.lit("DFT"))).otherwise(F.array(F.lit("wings"))).alias("keywords"),
        F.when(k % 5 != 0, F.struct(F.lit("cc-by-4.0").alias("id"))).alias("license"), F.lit("open").alias("access_right"),
    )
    hit = F.struct(k.alias("id"), F.when(k % 3 != 0, text("c", k % 40)).alias("conceptrecid"), F.lit("2024").alias("created"), meta.alias("metadata"), F.array(f("OUTCAR", F.col("o_custkey")), f("a.zip", F.when(k % 2 == 0, 5))).alias("files"))
    return t("orders").select(records.normalise_hit(hit).alias("c")).select("c.recid", "c.concept", "c.files_total", "c.bytes_total", F.array_join("c.signals", ",").alias("signals"), "c.license")


ACCESS, TYPES = ["open", "closed", None, "restricted"], ["dataset", "software", "publication"]


@query(f"""SELECT coalesce({sql_at(ACCESS, 'o_orderkey')} = 'open', true) AS open_, {sql_at(TYPES, 'o_orderkey')} IN ('dataset', 'software') AS typed, coalesce(nullif(o_orderkey % 6, 5) >= 3, false) AS ranked, count(*) AS n FROM orders GROUP BY ALL""")
def record_gates(t):
    k = F.col("o_orderkey")
    pushed, local = fetch.type_filter(["dataset", "software"], at(TYPES, k))
    assert pushed is None and fetch.type_filter(["dataset"], k) == ("dataset", None) and fetch.type_filter([], k) == (None, None)
    return t("orders").groupBy(records.open_access(at(ACCESS, k)).alias("open_"), local.alias("typed"), fetch.has_rank(F.when(k % 6 != 5, k % 6)).alias("ranked")).agg(F.count("*").alias("n"))


@query("""SELECT lic, n FROM (SELECT coalesce(o_orderpriority, 'null') AS lic, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, coalesce(o_orderpriority, 'null')) AS r FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) WHERE r <= 3""")
def dropped_licences(t):
    o = t("orders").select("o_orderstatus", F.col("o_orderpriority").alias("lic"))
    return agg.dropped_values(o, [("licence", F.col("o_orderstatus") != "O")], "licence", "lic", 3)


@query("""SELECT k, o_orderkey, o_custkey FROM (SELECT o_custkey % 100 AS k, o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey % 100 ORDER BY o_orderkey // 50 DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def newest_with_ties(t):
    o = t("orders").select((F.col("o_custkey") % 100).alias("k"), "o_orderkey", "o_custkey")
    return keys.newest_per_key(o, "k", F.floor(F.col("o_orderkey") / 50), "o_orderkey")


@query("""WITH s AS (SELECT o_custkey, o_orderkey, o_orderkey % 5 AS rank, min(o_orderkey) OVER (PARTITION BY o_custkey) AS seen FROM orders) SELECT o_orderkey, row_number() OVER (ORDER BY rank DESC, seen, o_orderkey) AS place FROM s QUALIFY place <= 200""")
def rank_order(t):
    rows = sample.by_rank(t("orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 5).alias("rank")), "rank", "o_custkey", "o_orderkey")
    return split.positions(rows.withColumn("down", -F.col("rank")), "down", "first_seen", "o_orderkey").where("position < 200").select("o_orderkey", (F.col("position") + 1).cast("long").alias("place"))


@query("SELECT user_id, n FROM (SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, user_id) AS r FROM events GROUP BY 1) WHERE r <= 10")
def top_users(t):
    return sample.top_n(t("events"), "user_id", 10)


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey > 50 GROUP BY 1 ORDER BY 1 LIMIT 40")
def count_pages(t):
    return sample.count_page(t("orders"), "o_custkey", 50, 40)


@query("""WITH c AS (SELECT o_custkey, min(o_orderkey) AS first_ FROM orders WHERE o_custkey % 10 <> 0 GROUP BY 1), have AS (SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE o_custkey % 10 = 0),
w AS (SELECT o_custkey FROM (SELECT *, row_number() OVER (ORDER BY first_, o_custkey) AS r FROM c) WHERE r <= (SELECT greatest(0, 300 - n) FROM have))
SELECT o_orderkey FROM orders WHERE o_custkey % 10 = 0 OR o_custkey IN (SELECT o_custkey FROM w)""")
def concept_limit(t):
    o = t("orders").select("o_orderkey", "o_custkey")
    return keys.limit_concepts(o, "o_custkey", "o_orderkey", 300, o.where("o_custkey % 10 = 0")).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM (SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey), o_custkey) AS r FROM orders GROUP BY 1) WHERE r <= 25)")
def bounded_peek(t):
    return keys.first_keys(t("orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey", 25).select("o_orderkey")


@query("SELECT tag, name, comment, count(*) AS n FROM (SELECT 0 AS tag, n_name AS name, NULL AS comment FROM nation UNION ALL SELECT 1, r_name, 'r' FROM region) GROUP BY ALL")
def bag_union(t):
    a, b = t("nation").select(F.col("n_name").alias("name")), t("region").select(F.col("r_name").alias("name"), F.lit("r").alias("comment"))
    return keys.union_all(a, b, tag="tag").groupBy("tag", "name", "comment").agg(F.count("*").alias("n"))


# --- stages -----------------------------------------------------------------------------


@query("""SELECT l_orderkey AS calc_id, l_linenumber AS pos, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_orderkey % 7 <> 0) WHERE r = 1""")
def parse_remaining(t):
    li = t("lineitem").select(F.col("l_orderkey").alias("calc_id"), F.struct("l_linenumber", "l_partkey").alias("pos"), "l_linenumber", "l_partkey")
    got = keys.parse_todo(li, t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("calc_id")), t("orders").where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("id")))
    return got.select("calc_id", F.col("l_linenumber").alias("pos"), "l_partkey")


@query("""SELECT user_id, max(event_id) AS event_id, 'row' AS kind FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1
UNION ALL SELECT c_custkey, NULL, 'unmatched' FROM customer WHERE c_custkey % 3 = 0 AND c_custkey NOT IN (SELECT user_id FROM events)""")
def repair_keep_list(t):
    rows, lost = keys.targets(t("events").select("user_id", "event_id"), t("customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id")), "user_id", "event_id")
    return rows.select("user_id", "event_id", F.lit("row").alias("kind")).unionByName(lost.select("user_id", F.lit(None).cast("long").alias("event_id"), F.lit("unmatched").alias("kind")))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN o_orderstatus = 'F' AND l_linenumber IN (1, 3) THEN l_linenumber * 0.5 + o_custkey END AS scf_de, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL""")
def per_step_values(t):
    maps = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("calc_id"), F.create_map(F.lit("1"), F.col("o_custkey") + 0.5, F.lit("3"), F.col("o_custkey") + 1.5).alias("per_step"))
    got = ds.apply_per_step(t("lineitem").select(F.col("l_orderkey").alias("calc_id"), F.col("l_linenumber").alias("ionic_step")), maps, "scf_de")
    return got.groupBy(F.col("calc_id").alias("l_orderkey"), F.col("ionic_step").alias("l_linenumber"), "scf_de").agg(F.count("*").alias("n"))


@query("""WITH h AS (SELECT l_orderkey % 500 AS recid, 'd' || (l_linenumber % 3) AS dir, CASE l_partkey % 3 WHEN 0 THEN 'CHGCAR' WHEN 1 THEN 'DOSCAR' ELSE 'notes' END || '.' || (l_suppkey % 5) AS f, l_partkey % 3 AS kind FROM lineitem),
m AS (SELECT recid, dir, min(CASE WHEN kind = 0 THEN dir || '/' || f END) AS chg, min(CASE WHEN kind = 1 THEN dir || '/' || f END) AS dos FROM h WHERE kind < 2 GROUP BY 1, 2)
SELECT u.recid, u.dir, chg, dos FROM (SELECT DISTINCT p_partkey % 500 AS recid, 'd' || (p_partkey % 2) AS dir FROM part) u LEFT JOIN m ON m.recid = u.recid AND m.dir = u.dir""")
def heavy_beside_units(t):
    h = t("lineitem").select((F.col("l_orderkey") % 500).alias("recid"), text("d", F.col("l_linenumber") % 3, "/", at(["CHGCAR", "DOSCAR", "notes"], F.col("l_partkey")), ".", F.col("l_suppkey") % 5).alias("path"))
    u = t("part").select((F.col("p_partkey") % 500).alias("recid"), text("d", F.col("p_partkey") % 2).alias("dir")).distinct()
    return ds.heavy_files(u, h).select("recid", "dir", F.col("heavy")["charge_density"].alias("chg"), F.col("heavy")["dos"].alias("dos"))


@query("""SELECT recid, path FROM (SELECT p_partkey % 200 AS recid, 'run' || (p_partkey % 3) || '/' || CASE p_partkey % 4 WHEN 0 THEN 'OUTCAR' WHEN 1 THEN 'INCAR' WHEN 2 THEN 'KPOINTS' ELSE 'x' || p_partkey END AS path FROM part) x
WHERE NOT ((path LIKE '%OUTCAR' OR path LIKE '%INCAR') AND EXISTS (SELECT 1 FROM part WHERE p_partkey % 4 = 0 AND p_partkey % 200 = recid AND 'run' || (p_partkey % 3) = split_part(path, '/', 1)))""")
def unreferenced_files(t):
    k = F.col("p_partkey")
    listing = t("part").select((k % 200).alias("recid"), text("run", k % 3, "/", F.when(k % 4 == 0, "OUTCAR").when(k % 4 == 1, "INCAR").when(k % 4 == 2, "KPOINTS").otherwise(text("x", k))).alias("path"))
    return ds.unreferenced(listing, ds.group_units(listing))


@query("""SELECT CASE p_size % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END + 0 AS kept, p_size % 4 >= 2 AS refused, count(*) AS n FROM part GROUP BY ALL""")
def oversized_primaries(t):
    size = F.col("p_size") % 4
    fits = ds.trim_oversized(F.create_map(F.lit("vasprun"), F.lit("v"), F.lit("outcar"), F.lit("o")), F.create_map(F.lit("v"), F.when(size == 1, 10).otherwise(99), F.lit("o"), F.when(size <= 1, 10).otherwise(99)), 50)
    return t("part").groupBy(F.size(fits).alias("kept"), (F.size(fits) == 0).alias("refused")).agg(F.count("*").alias("n"))


@query("""SELECT state, count(*) AS n, array_to_string(list_sort((list(k ORDER BY k))[1:3]::VARCHAR[]), ',') AS examples, true AS fatal FROM (SELECT coalesce(k1, k2) AS k, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'orphan' WHEN b > 1 THEN 'duplicate_on_disk' ELSE 'duplicate_in_meta' END AS state FROM
 (SELECT o_orderkey k1, count(*) a FROM orders WHERE o_orderkey % 9 <> 0 GROUP BY 1) FULL JOIN (SELECT l_orderkey k2, count(*) b FROM lineitem GROUP BY 1) ON k1 = k2 WHERE a IS NULL OR b IS NULL OR a > 1 OR b > 1) GROUP BY 1""")
def integrity_report(t):
    return ds.integrity(t("orders").where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("k")), t("lineitem").select(F.col("l_orderkey").alias("k")), "k", examples=3).withColumn("examples", F.array_join("examples", ","))


@query("""WITH s AS (SELECT 0 AS source, 'shard-' || lpad((s_suppkey % 7)::VARCHAR, 5, '0') || '.extxyz.gz' AS old, s_suppkey % 7 AS i FROM supplier UNION SELECT 1, 'shard-' || lpad((n_nationkey % 4)::VARCHAR, 5, '0') || '.extxyz.gz', n_nationkey % 4 FROM nation)
SELECT source, old, 'shard-' || lpad((2 + row_number() OVER (ORDER BY source, i, old))::VARCHAR, 5, '0') || '.extxyz.gz' AS new FROM (SELECT DISTINCT * FROM s)""")
def merged_shards(t):
    shard = lambda n: F.format_string("shard-%05d.extxyz.gz", n.cast("int"))
    rows = lambda df, k, m: df.select(k.cast(S).alias("calc_id"), F.array(shard(k % m)).alias("shards"))
    into = t("region").select(text("r", F.col("r_regionkey")).alias("calc_id"), F.array(shard(F.col("r_regionkey") % 3)).alias("shards"))
    return ds.merge_shards(into, [rows(t("supplier"), F.col("s_suppkey"), 7), rows(t("nation"), F.col("n_nationkey"), 4)])[1]


@query("""SELECT 'duplicate_id' AS problem, k AS what, count(*) AS n FROM (SELECT (s_suppkey % 60)::VARCHAR AS k FROM supplier UNION ALL SELECT n_nationkey::VARCHAR FROM nation) GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'missing_shard', 's' || (s_suppkey % 9), count(*) FROM supplier WHERE s_suppkey % 9 > 6 GROUP BY 2""")
def merge_refusals(t):
    a = t("supplier").select((F.col("s_suppkey") % 60).cast(S).alias("calc_id"), F.array(text("s", F.col("s_suppkey") % 9)).alias("shards"))
    b = t("nation").select(F.col("n_nationkey").cast(S).alias("calc_id"), F.array().cast("array<string>").alias("shards"))
    return ds.merge_problems(a, [b], t("part").select(text("s", F.col("p_partkey") % 7).alias("shard")))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def rewound(t):
    return ds.rewind(t("lineitem").select(F.col("l_orderkey").alias("k"), "l_returnflag"), t("orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("k")), "k").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey % 2 = 1 AND o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 AS done, count(*) AS n FROM orders GROUP BY 1")
def part_completeness(t):
    k = F.col("o_orderkey")
    return t("orders").groupBy(ds.part_complete(k % 2 == 0, k % 3, k % 5).alias("done")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 AND o_custkey % 4 <> 0 THEN 'new' || o_custkey % 4 ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'poor' ELSE 'rich' END END AS block, count(*) AS n FROM orders GROUP BY 1""")
def refreshed_blocks(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    calcs = t("orders").select(k.alias("calc_id"), F.when(k % 3 == 0, "outcar").otherwise("vasprun").alias("parser"), F.when(k % 2 == 0, "poor").otherwise("rich").alias("block"))
    new = t("orders").where(c % 4 != 0).select(k.alias("calc_id"), text("new", c % 4).alias("block"))
    return ds.refresh(calcs, new, "outcar", "block", F.col("block") == "poor").groupBy("block").agg(F.count("*").alias("n"))


@query("SELECT 'r' || (o_custkey % 30) AS record, 's:r' || (o_custkey % 30) || ':' || o_orderkey AS calc_id FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus = 'F'")
def repair_wanted(t):
    k = F.col("o_orderkey")
    calcs = t("orders").select(text("s:r", F.col("o_custkey") % 30, ":", k).alias("calc_id"), F.when(k % 3 == 0, "outcar").otherwise("vasprun").alias("parser"), "o_orderstatus")
    return ds.repair_targets(calcs, "outcar", F.col("o_orderstatus") == "F")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey * 0.5 ELSE o_orderkey % 7 END::DOUBLE AS net_magnetization, o_orderstatus AS kind FROM orders""")
def net_updates(t):
    o = t("orders").select(F.col("o_orderkey").alias("calc_id"), (F.col("o_orderkey") % 7).cast("double").alias("net_magnetization"), F.col("o_orderstatus").alias("kind"))
    new = t("orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("calc_id"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey") * 0.5).alias("net_magnetization"))
    return ds.apply_net_properties(o, new).select(F.col("calc_id").alias("o_orderkey"), "net_magnetization", "kind")


@query("""SELECT CASE WHEN p_partkey % 3 > 0 THEN (p_partkey % 5)::DOUBLE END AS m, CASE WHEN p_partkey % 3 > 0 THEN 'text' ELSE 'unavailable' END AS src, CASE WHEN p_partkey % 2 = 0 THEN round(p_size - 8.0, 6) END AS q, CASE p_partkey % 7 WHEN 0 THEN true WHEN 1 THEN false ELSE p_size < 20 END AS ionic, count(*) AS n FROM part GROUP BY ALL""")
def net_blocks(t):
    k, size = F.col("p_partkey"), F.col("p_size")
    known = F.when(k % 7 == 0, True).when(k % 7 == 1, False)
    b = ds.net_properties(F.when(k % 3 > 0, (k % 5).cast("double")), F.lit("text"), F.when(k % 2 == 0, size.cast("double")), F.lit(8.0), F.lit(20), F.lit(2), F.lit(-0.01), size, known)
    return t("part").groupBy(b["net_magnetization"].alias("m"), b["magnetization_source"].alias("src"), b["net_charge"].alias("q"), b["ionic_converged"].alias("ionic")).agg(F.count("*").alias("n"))


_STATUSES = ["parsed", "pending", "recoverable", "odd"]


@query(f"""WITH u AS (SELECT 'd' || (p_partkey % 97) AS dir, {sql_at(_STATUSES, 'p_partkey // 97')} AS s FROM part) SELECT dir, CASE WHEN bool_or(s = 'pending') THEN 'pending' WHEN bool_or(s = 'recoverable') THEN 'recoverable' WHEN bool_or(s = 'parsed') THEN 'parsed' ELSE 'odd' END AS status FROM u GROUP BY 1""")
def folder_strength(t):
    k = F.col("p_partkey")
    return ds.folder_status(t("part").select(text("d", k % 97).alias("dir"), at(_STATUSES, F.floor(k / 97)).alias("status")))


@query("""WITH f AS (SELECT o_orderkey % 10 AS d, o_orderkey % 3 AS e, o_custkey AS size FROM orders) SELECT CASE WHEN d = 4 THEN 'protected' WHEN d % 2 = 0 AND e = 1 THEN 'later' WHEN d % 2 = 0 THEN 'safe' ELSE 'review' END AS tier, count(*) AS files, sum(size)::BIGINT AS bytes FROM f GROUP BY 1""")
def reclaim_tiers(t):
    k = F.col("o_orderkey")
    f = t("orders").select(text("d", k % 10, "/e", k % 3, "/f", k).alias("path"), F.col("o_custkey").alias("size"))
    near = [(f"d{d}", "parsed") for d in range(0, 10, 2)] + [(f"d{d}/e1", "pending") for d in range(0, 10, 2)]
    spark = f.sparkSession
    return report.reclaim(f, spark.createDataFrame(near, "dir string, status string"), spark.createDataFrame([("d4", True), ("d5", False)], "dir string, keep boolean"))


@query("""SELECT category, coalesce(o_orderstatus, 'unknown') AS status, count(*) AS files, sum(s)::BIGINT AS bytes FROM (SELECT l_orderkey, l_returnflag AS category, l_quantity::BIGINT AS s FROM lineitem) LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 4 > 0) ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def staging_table(t):
    f = t("lineitem").select(F.col("l_orderkey").alias("recid"), F.col("l_returnflag").alias("category"), F.col("l_quantity").cast("long").alias("size"))
    return report.staging(f, t("orders").where("o_orderkey % 4 > 0").select(F.col("o_orderkey").alias("recid"), F.col("o_orderstatus").alias("status")))


@query("SELECT (SELECT sum(o_custkey)::BIGINT FROM orders) AS bytes, (SELECT count(*) FROM orders) AS files, (SELECT count(*) FROM (SELECT DISTINCT o_orderkey % 5 AS a FROM orders)) + (SELECT count(*) FROM (SELECT DISTINCT o_orderkey % 5, o_orderkey % 7 FROM orders)) AS dirs")
def folder_usage(t):
    k = F.col("o_orderkey")
    return report.usage(t("orders").select(text("a", k % 5, "/b", k % 7, "/f", k).alias("path"), F.col("o_custkey").alias("length")))


@query("""SELECT 'r' || (o_custkey % 50) AS recid, CASE o_orderkey % 3 WHEN 0 THEN 'ValueError' WHEN 1 THEN 'KeyError' ELSE 'a very long exception type that goes bey' END AS error, count(*) AS n, CASE WHEN o_custkey % 50 < 40 THEN 'title ' || (o_custkey % 50) END AS title FROM orders GROUP BY ALL""")
def parse_error_table(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rej = t("orders").select(text("s:r", c % 50, ":x/", k).alias("id"), at(["ValueError: bad", "KeyError: 'x': y", "a very long exception type that goes beyond forty: z"], k).alias("detail"))
    titles = t("customer").select((F.col("c_custkey") % 50).alias("i")).distinct().where("i < 40").select(text("r", F.col("i")).alias("recid"), text("title ", F.col("i")).alias("title"))
    return report.parse_errors(rej, titles).select("recid", "error", "n", "title")


@query("""WITH keep AS (SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey % 2 = 0), f AS (SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey % 6 = 0), p AS (SELECT DISTINCT s_suppkey AS id FROM supplier WHERE s_suppkey % 4 = 0), r AS (SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey % 5 = 0),
d AS (SELECT id FROM f UNION SELECT id FROM p), t AS (SELECT id FROM (SELECT id FROM d UNION SELECT id FROM r) WHERE id IN (SELECT id FROM keep)), dk AS (SELECT id FROM d WHERE id IN (SELECT id FROM keep)),
n AS (SELECT (SELECT count(*) FROM customer) AS candidates, (SELECT count(*) FROM keep) AS keep, (SELECT count(*) FROM f) AS fetched, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 0) AS calcs, (SELECT count(*) FROM t) AS attempted, (SELECT count(*) FROM dk) AS done,
 (SELECT 3 * count(*) FROM customer WHERE c_custkey % 6 = 0)::BIGINT AS units, (SELECT 2 * count(*) FROM supplier WHERE s_suppkey % 4 = 0)::BIGINT AS frames)
SELECT *, greatest(0, keep - attempted) AS untouched, greatest(0, attempted - done) AS fetch_rejected, round(100.0::DOUBLE * attempted / keep, 1) AS fetch_percent, round(100.0::DOUBLE * calcs / units, 1) AS parse_percent FROM n""")
def status_report(t):
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    cust = t("customer")
    keep = cust.where(c % 2 == 0).select(c.cast(S).alias("recid"))
    fetched = cust.where(c % 6 == 0).select(c.cast(S).alias("recid"), F.lit(3).alias("n_calc_units"))
    calcs = t("supplier").where(s % 4 == 0).select(text("s:", s, ":run/OUTCAR").alias("calc_id"), F.array(F.lit("a"), F.lit("b")).alias("frame_ids"))
    rej = cust.where(c % 5 == 0).select(F.lit("fetch").alias("stage"), c.cast(S).alias("id")).unionByName(cust.where(c % 5 == 1).select(F.lit("fetch").alias("stage"), text("x:", c).alias("id")))
    return report.status(cust.select(c.cast(S).alias("recid")), keep, fetched, calcs, rej)


@query("""SELECT (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) + (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS keep, false AS fetched, true AS units""")
def funnel_identities(t):
    o = t("orders").select("o_orderkey").join(t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n")), "o_orderkey", "left")
    r = o.agg(F.count("*").alias("a"), F.count("n").alias("b"), F.count_if(F.col("n").isNull()).alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("u")).first()
    got = report.funnel(r.a, r.b, r.c, r.b, 1, r.u, r.u, 0)
    return o.sparkSession.createDataFrame([(got["keep"], got["fetched"], got["units"])], "keep boolean, fetched boolean, units boolean")


_RUN = ["PBE", "HSE06", None]


@query(f"""WITH c AS (SELECT o_orderkey % 4 AS frames, CASE WHEN o_orderkey % 2 = 0 THEN 'vasprun' ELSE 'outcar' END AS parser, {sql_at(_RUN, 'o_orderkey')} AS run_type, 'PBE' AS functional, CASE WHEN o_orderkey % 5 > 0 THEN 'cc-by-4.0' END AS license, o_orderpriority AS resource_type FROM orders),
u AS (SELECT frames, unnest([{{'k': 'parser', 'v': parser}}, {{'k': 'run_type', 'v': run_type}}, {{'k': 'functional', 'v': functional}}, {{'k': 'license', 'v': license}}, {{'k': 'resource_type', 'v': resource_type}}]) AS x FROM c)
SELECT x.k AS key, coalesce(x.v, 'null') AS value, sum(frames)::BIGINT AS frames, count(*) AS calcs FROM u GROUP BY ALL""")
def dataset_summary(t):
    k = F.col("o_orderkey")
    c = t("orders").select(
        F.array_repeat(F.lit("f"), (k % 4).cast("int")).alias("frame_ids"), F.when(k % 2 == 0, "vasprun").otherwise("outcar").alias("parser"), F.struct(at(_RUN, k).alias("run_type"), F.lit("PBE").alias("functional")).alias("calc_parameters"),
        F.struct(F.when(k % 5 > 0, "cc-by-4.0").alias("license"), F.col("o_orderpriority").alias("resource_type")).alias("provenance"),
    )
    return agg.dataset_stats(c)


@query("""WITH p AS (SELECT o_custkey, sum(round(o_totalprice)::BIGINT) AS v FROM orders GROUP BY 1), r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, row_number() OVER (ORDER BY v DESC, o_custkey) AS top, count(*) OVER () AS n FROM p)
SELECT count(*) AS records, sum(v)::BIGINT AS bytes, max(v) AS largest, max(v) FILTER (i = n // 2) AS median, round(sum(v) FILTER (top <= 10)::DOUBLE / sum(v), 6) AS top_share FROM r""")
def storage_census(t):
    f = t("orders").select("o_custkey", F.round("o_totalprice").cast("long").alias("v"), F.lit("a.zip").alias("name"))
    return agg.census(f, "o_custkey", "v", "name")[0]


@query(f"""WITH n AS (SELECT {sql_name('p_partkey')} AS name, p_size FROM part) SELECT regexp_extract(lower(name), '(\\.tar\\.(gz|bz2|xz)|\\.[^./]*)$', 1) AS ext, count(*) AS files, sum(p_size)::BIGINT AS bytes FROM n GROUP BY 1""")
def census_by_kind(t):
    return agg.census(t("part").select(F.col("p_partkey").alias("recid"), name_of(F.col("p_partkey")).alias("name"), "p_size"), "recid", "p_size", "name")[1]


@query("""SELECT lang, sum(n_chars)::BIGINT AS transfer, sum(n_chars) * 1.5 AS extracted, sum(n_chars) * 0.25 AS stored FROM documents GROUP BY 1""")
def projected_bytes(t):
    totals = t("documents").groupBy("lang").agg(F.sum("n_chars").alias("transfer"))
    ratios = totals.sparkSession.createDataFrame([(1.5, 0.25)], "extract_ratio double, frame_ratio double")
    return agg.project_ratios(totals, ratios).select("lang", "transfer", "extracted", "stored")


@query("SELECT coalesce(sum(CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END), 0)::BIGINT AS a, 0::BIGINT AS b, sum(o_orderkey)::BIGINT AS c FROM orders")
def null_safe_totals(t):
    k = F.col("o_orderkey")
    return sample.totals(t("orders").select(F.when(k % 3 > 0, F.col("o_custkey")).alias("a"), F.lit(None).cast("long").alias("b"), k.alias("c")), "a", "b", "c")


@query("""WITH p AS (SELECT l_orderkey % 1000 AS recid, sum(l_linenumber) AS frames, sum(l_quantity::BIGINT) AS bytes, count(*) AS calcs FROM lineitem WHERE l_orderkey % 1000 < 300 GROUP BY 1), a AS (SELECT count(*) AS attempted, sum(o_custkey) FILTER (o_orderkey < 500) AS dl, count(*) FILTER (o_orderkey < 500) AS fetched FROM orders WHERE o_orderkey < 800),
n AS (SELECT attempted, fetched, dl::BIGINT AS downloaded, count(*) AS parsed, sum(frames)::BIGINT AS frames, sum(calcs)::BIGINT AS calcs, sum(bytes)::BIGINT AS stored FROM p, a GROUP BY 1, 2, 3)
SELECT *, round(fetched::DOUBLE / attempted, 3) AS yield_fetch, round(parsed::DOUBLE / attempted, 3) AS yield_parse, round(stored::DOUBLE / frames, 1) AS bytes_per_frame, round(stored::DOUBLE / downloaded, 5) AS stored_per_downloaded, round(frames::DOUBLE / parsed, 2) AS frames_per_record FROM n""")
def yield_ratios(t):
    tried = t("orders").where("o_orderkey < 800").select(F.col("o_orderkey").alias("recid"), F.col("o_custkey").alias("bytes"))
    calcs = t("lineitem").select((F.col("l_orderkey") % 1000).alias("recid"), F.col("l_linenumber").alias("frames"), F.col("l_quantity").cast("long").alias("bytes")).where("recid < 300")
    return sample.yields(tried, tried.where("recid < 500"), calcs)


@query("""WITH o AS (SELECT o_orderkey, o_custkey::BIGINT AS b, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders), s AS (SELECT o_orderkey, b, row_number() OVER (ORDER BY b, o_orderkey) - 1 AS i FROM o WHERE i IN (SELECT floor(j * n / 60.0)::BIGINT FROM (SELECT unnest(range(60)) AS j), (SELECT count(*) AS n FROM orders))),
k AS (SELECT count(*) AS n, greatest(1, floor(count(*) * (20000 / sum(b)::DOUBLE)))::BIGINT AS k, sum(b) AS t FROM s), p AS (SELECT o_orderkey, b, row_number() OVER (ORDER BY b DESC, i) AS r, sum(b) OVER () AS t, coalesce(sum(b) OVER (ORDER BY b DESC, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, count(*) OVER () AS n FROM s WHERE (SELECT t <= 20000 FROM k) OR i IN (SELECT floor(j * k.n / k.k::DOUBLE)::BIGINT FROM k, (SELECT unnest(range(60)) AS j) WHERE j < k.k))
SELECT o_orderkey, b FROM p WHERE t - before <= 20000 OR r = n""")
def sample_in_budget(t):
    o = t("orders").select("o_orderkey", F.col("o_custkey").cast("long").alias("b"))
    return sample.budgeted_sample(o, ["b", "o_orderkey"], "b", 60, 20_000)


@query("""WITH RECURSIVE g AS (SELECT o_custkey, count(*) w, row_number() OVER (ORDER BY count(*) DESC, o_custkey) i FROM orders WHERE o_custkey % 5 = 0 GROUP BY 1),
r AS (SELECT 0::BIGINT AS i, [0, 0, 0]::BIGINT[] AS load, NULL::BIGINT AS k, NULL::INT AS part UNION ALL SELECT g.i, list_transform(r.load, lambda x, j: CASE WHEN j = list_position(r.load, list_min(r.load)) THEN x + g.w ELSE x END), g.o_custkey, list_position(r.load, list_min(r.load)) - 1 FROM r JOIN g ON g.i = r.i + 1)
SELECT part, count(*) AS n, count(DISTINCT o_custkey) AS groups FROM r JOIN orders ON o_custkey = k GROUP BY 1""")
def grouped_split(t):
    return split.split_groups(t("orders").where("o_custkey % 5 = 0").select("o_orderkey", "o_custkey"), "o_custkey", 3).groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("groups"))


@query("""SELECT l_suppkey AS archive, sum(l_quantity::BIGINT)::BIGINT AS bytes, count(*) + 3 AS inodes FROM lineitem GROUP BY 1""")
def footprints(t):
    return fetch.footprint(t("lineitem").select(F.col("l_suppkey").alias("archive"), F.col("l_quantity").cast("long").alias("size")), "archive")


@query("""WITH RECURSIVE m AS (SELECT s_suppkey AS archive, s_nationkey * 1000 + i * i * 37 AS a, s_nationkey * 1000 + i * i * 37 + 100 AS b, i FROM supplier, (SELECT unnest(range(12)) AS i) WHERE s_suppkey <= 50),
r AS (SELECT archive, i, a, b, a AS start, 0 AS span FROM m WHERE i = 0 UNION ALL SELECT m.archive, m.i, m.a, m.b, CASE WHEN m.b - r.start > 1500 THEN m.a ELSE r.start END, CASE WHEN m.b - r.start > 1500 THEN r.span + 1 ELSE r.span END FROM r JOIN m ON m.archive = r.archive AND m.i = r.i + 1)
SELECT archive, span, min(a) AS start, max(b) AS stop, sum(b - a)::BIGINT AS wanted, greatest(max(b) - min(a) - sum(b - a), 0)::BIGINT AS wasted FROM r GROUP BY 1, 2""")
def span_requests(t):
    i = F.col("i")
    m = t("supplier").where("s_suppkey <= 50").select(F.col("s_suppkey").alias("archive"), "s_nationkey", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i"))
    m = m.select(F.col("archive").cast(S).alias("archive"), i.cast(S).alias("name"), (F.col("s_nationkey") * 1000 + i * i * 37).alias("offset"), (F.col("s_nationkey") * 1000 + i * i * 37 + 100).alias("end"))
    return fetch.span_ranges(fetch.span_groups(m, 1500)).withColumn("archive", F.col("archive").cast("long"))


# --- texts and quantities ---------------------------------------------------------------

SEGMENTS = ["a", ".", "..", "b", ""]
_STEP = lambda acc, seg: f"CASE WHEN {acc} IS NULL OR {seg} IN ('', '.') THEN {acc} WHEN {seg} = '..' THEN CASE WHEN len({acc}) > 0 THEN {acc}[1:len({acc}) - 1] END ELSE list_append({acc}, {seg}) END"


@query(f"""WITH s AS (SELECT {sql_at(SEGMENTS, 'o_orderkey')} AS a, {sql_at(SEGMENTS, 'o_orderkey // 5')} AS b, {sql_at(SEGMENTS, 'o_orderkey // 25')} AS c FROM orders), x AS (SELECT *, {_STEP('([]::VARCHAR[])', 'a')} AS l1 FROM s), y AS (SELECT *, {_STEP('l1', 'b')} AS l2 FROM x), z AS (SELECT *, {_STEP('l2', 'c')} AS l3 FROM y)
SELECT a || '/' || b || '/' || c AS path, CASE WHEN a <> '' THEN array_to_string(l3, '/') END AS normal, CASE WHEN a <> '' THEN array_to_string(l3, '/') = 'a' OR starts_with(array_to_string(l3, '/'), 'a/') END AS inside, CASE WHEN a = '' THEN a || '/' || b || '/' || c ELSE '/raw/' || a || '/' || b || '/' || c END AS resolved, count(*) AS n FROM z GROUP BY ALL""")
def path_rules(t):
    k = F.col("o_orderkey")
    p = t("orders").select(text(at(SEGMENTS, k), "/", at(SEGMENTS, F.floor(k / 5)), "/", at(SEGMENTS, F.floor(k / 25))).alias("path"))
    n = p.select("path", files.normal_path(F.col("path")).alias("normal"))
    return n.groupBy("path", "normal", files.inside(F.col("normal"), F.lit("a")).alias("inside"), fetch.resolve_path(F.col("path"), F.lit("/raw/")).alias("resolved")).agg(F.count("*").alias("n"))


IDS = ["s:12:a/vasprun.xml.gz", "12", "s:7", "s:9:x:y/vaspout.h5", "s:3:OUTCAR", "s:4:run.h5"]


@query(f"""WITH v AS (SELECT {sql_at(IDS, 'o_orderkey')} AS id FROM orders) SELECT id, CASE WHEN len(string_split(id, ':')) >= 3 THEN string_split(id, ':')[2] ELSE string_split(id, ':')[1] END AS rec,
 CASE WHEN contains(lower(string_split(id, ':')[-1]), 'vasprun') THEN 'vasprun' WHEN ends_with(lower(id), '.h5') OR contains(lower(string_split(id, ':')[-1]), 'vaspout') THEN 'vaspout' ELSE 'outcar' END AS family, 'z:' || string_split(id, ':')[1] || ':p' AS made, count(*) AS n FROM v GROUP BY ALL""")
def id_rules(t):
    c = F.col("id")
    return t("orders").select(at(IDS, F.col("o_orderkey")).alias("id")).groupBy("id", records.record_id(c).alias("rec"), headers.parser_family(c).alias("family"), records.calc_id(F.lit("z"), F.split_part(c, F.lit(":"), F.lit(1)), F.lit("p")).alias("made")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 3 ELSE 0 END + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS n, CASE WHEN c_custkey % 2 = 0 THEN '10.1/' || c_custkey WHEN c_custkey % 3 > 0 THEN 'r' END AS last_ FROM customer""")
def reference_lists(t):
    k = F.col("c_custkey")
    refs = records.references(F.when(k % 3 > 0, F.array_repeat(F.lit("r"), (k % 3).cast("int"))), F.when(k % 2 == 0, F.array(F.struct(text("10.1/", k).alias("doi")), F.struct(F.lit(None).cast(S).alias("doi")))))
    return t("customer").select("c_custkey", F.size(refs).cast("long").alias("n"), F.try_element_at(refs, F.lit(-1)).alias("last_"))


@query("""WITH b AS (SELECT (c_custkey * pow(10, c_custkey % 13))::BIGINT AS v FROM customer) SELECT v, CASE WHEN v < 1000 THEN v || ' B' WHEN v < 1e6 THEN printf('%.1f KB', v / 1e3) WHEN v < 1e9 THEN printf('%.1f MB', v / 1e6) WHEN v < 1e12 THEN printf('%.1f GB', v / 1e9) WHEN v < 1e15 THEN printf('%.1f TB', v / 1e12) ELSE printf('%.1f PB', v / 1e15) END AS shown, round(100.0::DOUBLE * (v % 97) / nullif(v % 4, 0), 1) AS pc FROM b""")
def shown_bytes(t):
    v = t("customer").select((F.col("c_custkey") * F.pow(F.lit(10.0), F.col("c_custkey") % 13)).cast("long").alias("v"))
    return v.select("v", records.human_bytes(F.col("v")).alias("shown"), records.percent(F.col("v") % 97, F.col("v") % 4).alias("pc"))


WORDS = ["VASP runs", "a vasp and DFT study", "first-principles, First principles", "nothing here", "PAW plane waves", "plane-wave dft DFT"]


@query(f"""SELECT t AS text, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?i)\\b(vasp|vasprun|outcar|incar|first[ -]principles|density[ -]functional|dft|ab[ -]initio|projector[ -]augmented|paw|plane[ -]wave)\\b', 1), lambda x: lower(x)))), ',') AS signals, count(*) AS n FROM (SELECT {sql_at(WORDS, 'o_orderkey')} AS t FROM orders) GROUP BY ALL""")
def text_signals(t):
    x = t("orders").select(at(WORDS, F.col("o_orderkey")).alias("text"))
    return x.select("text", F.array_join(records.metadata_signals(F.col("text")), ",").alias("signals")).groupBy("text", "signals").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey AS k, sha1(string_agg(x, chr(10) ORDER BY l_linenumber, x))[1:16] AS print FROM (SELECT DISTINCT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'PAW H' WHEN 1 THEN 'PAW O' ELSE 'PAW Fe_pv' END AS x FROM lineitem WHERE l_linenumber % 4 <> 3) GROUP BY 1""")
def title_prints(t):
    x = t("lineitem").where("l_linenumber % 4 <> 3").select("l_orderkey", F.struct("l_linenumber", at(["PAW H", "PAW O", "PAW Fe_pv"], F.col("l_linenumber")).alias("x")).alias("s")).distinct()
    lists = x.groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list("s")).alias("a"))
    return lists.select("k", records.pseudopotential_set(F.concat(F.array(F.lit("")), F.transform("a", lambda s: s["x"]))).alias("print"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN round(p_size + 0.123456789, 8) ELSE p_size + 0.5 END::DOUBLE AS energy, (p_size - p_partkey % 5)::DOUBLE AS ts, round(-0.1 * 0.006241509125883258 * (p_size + 3), 6) AS yz, round(p_size * 0.5 - 0.25, 6)::DOUBLE AS occ, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 3 END AS runs FROM part""")
def quantities(t):
    k, s = F.col("p_partkey"), F.col("p_size").cast("double")
    m = F.array(*[F.array(*[s + 3 * i + j - 2 for j in range(3)]) for i in range(3)])
    up, down = F.array(F.array(s, F.lit(1.0)), F.array(F.lit(0.5))), F.array(F.array(F.lit(0.5), F.lit(1.0)), F.array(F.lit(0.5)))
    names = F.when(k % 2 == 0, F.array(F.lit("H"), F.lit("H"), F.lit("O"))).otherwise(F.array(F.lit("H"), F.lit("O"), F.lit("H")))
    return t("part").select(
        "p_partkey", physics.corrected_energy(s + 0.5, F.when(k % 2 == 0, s + 0.123456789).otherwise(s + 0.5)).alias("energy"), physics.entropy_term(s, (k % 5).cast("double")).alias("ts"), F.round(F.get(physics.stress_voigt(m), 3), 6).alias("yz"),
        physics.occupancy_moment(up, down, F.array(F.lit(0.5), F.lit(0.5))).alias("occ"), F.size(physics.species_runs(names)).alias("runs"),
    )


@query("""SELECT coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'p' END, CASE WHEN o_orderkey % 3 = 0 THEN 'i' END, CASE WHEN o_orderkey % 5 = 0 THEN 'r' END) AS v, (o_orderkey % 4 = 2) OR o_orderkey % 6 = 0 OR coalesce(o_orderkey % 7 = 0, false) AS magnetic, (o_orderkey % 3 = 0) AND ((o_orderkey % 4 = 2) OR o_orderkey % 6 = 0 OR o_orderkey % 7 = 0) AS spin, count(*) AS n FROM orders GROUP BY ALL""")
def tag_and_spin(t):
    k = F.col("o_orderkey")
    m = lambda d, v: F.create_map(F.lit("NSW"), F.when(k % d == 0, v))
    resolved = F.create_map(F.lit("NSW"), F.struct(F.when(k % 5 == 0, "r").alias("value"), F.lit("x").alias("source")))
    mag = physics.is_magnetic(k % 4, k % 6 == 0, F.when(k % 7 == 0, True))
    a = physics.spin_availability(k % 3 == 0, mag, mag)
    return t("orders").groupBy(physics.lookup("NSW", m(2, "p"), m(3, "i"), resolved).alias("v"), a["magnetization"].alias("magnetic"), a["spin_density"].alias("spin")).agg(F.count("*").alias("n"))


@query("""SELECT conv_id AS calc_id, count(*) AS n_frames, max(abs(length(text) - turn) / 2.0)::DOUBLE AS dev, count(*) FILTER (role = 'user') AS forces FROM conversations GROUP BY 1""")
def frame_quality(t):
    c = t("conversations").select(F.col("conv_id").alias("calc_id"), F.col("turn").alias("ionic_step"), F.lit(True).alias("electronic_converged"), F.when(F.col("role") == "user", "f").alias("forces"), F.length("text").cast("double").alias("e_free"), F.col("turn").cast("double").alias("ref_energy"), F.lit(2).alias("n_atoms"))
    return agg.calc_quality(c).select("calc_id", "n_frames", F.col("max_abs_free_minus_e0_per_atom").alias("dev"), F.col("n_frames_with_forces").alias("forces"))


@query("""SELECT CASE o_orderkey % 3 WHEN 0 THEN 'vasprun' WHEN 1 THEN 'vaspout' ELSE 'outcar' END AS parser, x.f AS field, count(*) AS n, count(*) FILTER (x.v) AS filled, round(100.0 * count(*) FILTER (x.v) / count(*), 2) AS percent FROM
 (SELECT o_orderkey, unnest([{'f': 'magnetization', 'v': o_orderkey % 2 = 0}, {'f': 'note', 'v': o_orderkey % 5 > 1}]) AS x FROM orders) GROUP BY ALL""")
def coverage_by_parser(t):
    k = F.col("o_orderkey")
    f = t("orders").select(headers.parser_family(text("s:1:", at(["vasprun.xml", "vaspout.h5", "OUTCAR"], k))).alias("parser"), F.when(k % 2 == 0, 1.0).alias("magnetization"), F.when(k % 5 > 1, "x").when(k % 5 == 1, "").alias("note"))
    return agg.presence(f, "parser", ["magnetization", "note"])


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS kept, CASE p_size % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS dropped, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN 2 ELSE 0 END AS first_ FROM part""")
def kept_steps(t):
    s = F.col("p_size") % 4
    k = headers.kept_steps(F.array(F.when(s >= 2, 1.0), F.lit(None).cast("double"), F.when(s >= 1, 2.0)))
    return t("part").select("p_partkey", F.size(k["kept"]).alias("kept"), k["dropped"].alias("dropped"), F.get(k["kept"], 0)["step"].alias("first_"))


@query("""SELECT CASE WHEN p_size % 4 > 0 THEN p_size % 2 = 0 END AS converged, CASE WHEN p_size % 4 >= 2 THEN 0.5 END::DOUBLE AS de, count(*) AS n FROM part GROUP BY ALL""")
def final_verdicts(t):
    s = F.col("p_size")
    v = scf.final_verdict(F.slice(F.array(F.lit(1.0), F.lit(1.5), F.lit(2.0)), F.lit(1), (s % 4).cast("int")), s % 2 == 0)
    return t("part").groupBy(v["electronic_converged"].alias("converged"), v["scf_de"].alias("de")).agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT DISTINCT l_orderkey AS f, l_linenumber AS i FROM lineitem WHERE l_orderkey % 20 = 0 AND l_linenumber <> 2), e AS (SELECT f, i, 1 + (f // 20) % 4 AS n FROM x), t AS (SELECT f, max(i) AS top FROM x GROUP BY 1), d AS (SELECT f, unnest(range(1, top + 1)) AS i FROM t)
SELECT d.f AS file, (d.i - 1)::INT AS ionic_step, coalesce(n, 0)::INT AS n_esteps, CASE WHEN n IS NOT NULL AND d.i <> 3 THEN 1.0 / n END::DOUBLE AS scf_de, CASE WHEN n > 0 THEN n < 3 END AS electronic_converged FROM d LEFT JOIN e ON e.f = d.f AND e.i = d.i""")
def scf_traces(t):
    x = t("lineitem").where("l_orderkey % 20 = 0 and l_linenumber <> 2").select(F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("i")).distinct()
    e = x.withColumn("e", F.explode(F.sequence(F.lit(1), (1 + F.floor(F.col("file") / 20) % 4).cast("int"))))
    mark = F.struct((F.col("i") * 1000 + F.col("e") * 10).alias("line_no"), F.format_string("------- Iteration %6d(%4d)  -----", "i", "e").alias("value"))
    change = F.struct((F.col("i") * 1000 + F.col("e") * 10 + 1).alias("line_no"), F.when(F.col("i") == 3, " total energy-change (2. order) : ****").otherwise(F.concat(F.lit(" total energy-change (2. order) :-"), (1.0 / F.col("e")).cast(S))).alias("value"))
    lines = e.select("file", F.explode(F.array(mark, change)).alias("r")).select("file", "r.*")
    return scf.verdicts(scf.trace(lines), F.lit(3))


_HEAD = " vasp.6.%d.1 build\\n INCAR:\\n   ENCUT = %d ! eV\\n   ismear = 0; SIGMA = 0.05\\n%s POTCAR:    PAW_PBE Fe 06Sep2000\\n   TITEL  = PAW_PBE Fe_pv 06Sep2000\\n   TITEL  = PAW_PBE O 08Apr2002\\n   TITEL  = PAW_PBE Fe_pv 06Sep2000\\n   LEXCH  = PE\\n NKPTS = %d\\n generate k-points for: 4 4 %d\\n Startparameter for this run:\\n   ENCUT = 999.0 eV; ISPIN  = %d\\n   NELM = 90; NELMIN= 2\\n   GGA = %s\\n   LEXCH = 8\\n   NOTATAG = 3\\n   GGA = XX\\n Iteration 1( 1)\\n NELM = 5"


@query("""SELECT p_partkey AS k, '6.' || (p_partkey % 4) || '.1' AS code_version, CASE WHEN p_partkey % 2 = 0 THEN 'PBE' ELSE 'PBEsol' END || CASE WHEN p_partkey % 3 = 0 THEN '+U' ELSE '' END || CASE WHEN p_partkey % 5 = 0 THEN '+vdW-DFT-D3' ELSE '' END AS run_type, (300 + p_size)::DOUBLE AS encut, 0.05::DOUBLE AS sigma, 1 + p_partkey % 2 = 2 AS spin,
 'PAW_PBE Fe_pv 06Sep2000,PAW_PBE O 08Apr2002' AS titles, 'PE' AS lexch, (p_size + 1)::INT AS count, '4,4,' || (1 + p_size % 3) AS points, CASE WHEN p_partkey % 3 = 0 THEN '4.0 0.0' END AS u, sha1('PAW_PBE Fe_pv 06Sep2000' || chr(10) || 'PAW_PBE O 08Apr2002')[1:16] AS print, 90 AS nelm, 5 AS effective, 18 + CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 0 END + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS lines FROM part""")
def header_parameters(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    extra = F.concat(F.when(k % 3 == 0, "   LDAU = .TRUE.\n   LDAUU = 4.0 0.0\n").otherwise(""), F.when(k % 5 == 0, "   IVDW = 11\n").otherwise(""))
    head = F.format_string(_HEAD.replace("\\n", "\n"), k % 4, 300 + s, extra, s + 1, 1 + s % 3, 1 + k % 2, F.when(k % 2 == 0, "PE").otherwise("PS"))
    got = headers.calc_parameters(t("part").select(k.alias("k"), head.alias("text")), "text")
    c = F.col("calc_parameters")
    return got.select(
        "k", c["code_version"].alias("code_version"), c["run_type"].alias("run_type"), c["encut"].alias("encut"), c["sigma"].alias("sigma"), c["spin_polarized"].alias("spin"), F.array_join(c["potcar_symbols"], ",").alias("titles"), F.array_join(c["xc_lexch"], ",").alias("lexch"),
        c["kpoints"]["count"].alias("count"), F.array_join(c["kpoints"]["points"].cast("array<string>"), ",").alias("points"), c["hubbard_u"]["LDAUU"].alias("u"), c["potcar_set_hash"].alias("print"), headers.max_steps(F.col("text")).alias("nelm"),
        F.size(c["parameters"]).alias("effective"), F.size(headers.header(F.col("text"))).alias("lines"),
    )


@query("""WITH p AS (SELECT p_partkey AS k, p_size AS s, p_partkey % 4 AS mag, p_partkey % 3 AS spin, p_partkey % 5 AS val FROM part), v AS (SELECT *, CASE WHEN val = 0 THEN 14.0 * 2 + 6.0 * s WHEN val = 1 THEN 10.0 * 2 + 6.0 * s END::DOUBLE AS neutral FROM p)
SELECT k, CASE mag WHEN 0 THEN s + 0.25 WHEN 1 THEN 5.0 * s ELSE CASE WHEN spin <> 1 THEN 0.0 END END::DOUBLE AS moment, CASE mag WHEN 0 THEN 'outcar' WHEN 1 THEN 'outcar_ncl' ELSE CASE WHEN spin <> 1 THEN 'nonmagnetic' ELSE 'unavailable' END END AS source,
 neutral, CASE WHEN val <> 2 THEN neutral - (20 + s) END::DOUBLE AS charge, CASE WHEN neutral IS NULL THEN 'unavailable' WHEN val = 0 THEN 'outcar_header' ELSE 'potcar_stats' END AS charge_source, spin = 1 AS magnetic FROM v""")
def electronic_blocks(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    val, mag = k % 5, k % 4
    zval = F.when(val == 0, "   POMASS =   55.847; ZVAL   =   14.000    mass\n   POMASS =   16.000; ZVAL   =    6.000\n").otherwise("")
    titles = F.when(val <= 1, "   TITEL  = PAW_PBE Fe_pv 06Sep2000\n   TITEL  = PAW_PBE O 08Apr2002\n").when(val == 2, "   TITEL  = PAW_PBE X 1\n").otherwise("")
    line = lambda v: text(" number of electron      22.0000000 magnetization       ", v, "\n")
    moments = F.when(mag == 0, F.concat(line(F.lit("9.0")), line(s + 0.25))).when(mag == 1, line(F.concat_ws(" ", (s * 3.0).cast(S), (s * -4.0).cast(S), F.lit("0.0")))).otherwise("")
    head = text(titles, zval, "   ions per type =               2   ", s, "\n Startparameter for this run:\n   ISPIN = ", F.when(k % 3 == 1, 2).otherwise(1), "\n", F.when(val != 2, text("   NELECT = ", s + 20, ".0\n")).otherwise(""), "   POMASS = 1; ZVAL = 99\n", moments)
    table = F.create_map(F.lit("PAW_PBEFe_pv06Sep2000"), F.lit(10.0), F.lit("PAW_PBEO08Apr2002"), F.lit(6.0))
    got = headers.electronic(headers.calc_parameters(t("part").select(k.alias("k"), head.alias("text")), "text"), "text", table)
    e = F.col("electronic")
    return got.select(
        "k", e["net_magnetization"].alias("moment"), e["magnetization_source"].alias("source"), e["nelect_neutral"].alias("neutral"), e["net_charge"].alias("charge"), e["charge_source"].alias("charge_source"),
        headers.is_magnetic(F.col("calc_parameters")).alias("magnetic"),
    )


@query("""SELECT CASE WHEN o_orderkey % 2 = 0 THEN '400' WHEN o_orderkey % 3 = 0 THEN '500' END AS encut, 1 + CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS n, CASE WHEN o_orderkey % 2 = 0 THEN '{"a":1,"b":null}' ELSE '{"a":1,"b":"x"}' END AS json, count(*) AS c FROM orders GROUP BY ALL""")
def raw_parameters(t):
    k = F.col("o_orderkey")
    raw = F.create_map(F.lit("ENCUT"), F.when(k % 2 == 0, "400"), F.lit("ENMAX"), F.when(k % 3 == 0, "500"), F.lit("NSW"), F.lit("3"), F.lit("OTHER"), F.lit("x"), F.lit("ISIF"), F.lit(None).cast(S))
    m = headers.restrict(raw)
    return t("orders").groupBy(F.element_at(m, F.lit("ENCUT")).alias("encut"), F.size(m).alias("n"), headers.as_json(F.struct(F.lit(1).alias("a"), F.when(k % 2 == 1, "x").alias("b"))).alias("json")).agg(F.count("*").alias("c"))


@query("""WITH t AS (SELECT DISTINCT 'PAW_PBE E' || (p_partkey % 40) || ' 06Sep2000' AS title FROM part), r AS (SELECT CASE s_suppkey % 3 WHEN 0 THEN 'PBE_54' WHEN 1 THEN 'LDA' ELSE 'OWN' END AS f, 'PAW_PBEE' || (s_suppkey % 30) || '06Sep2000' AS p, s_suppkey % 3 * 10 + s_suppkey % 30 AS z, s_suppkey % 3 AS o FROM supplier)
SELECT title, arg_min(z, o)::DOUBLE AS zval FROM t JOIN (SELECT p, min(z) AS z, o FROM r GROUP BY p, o) ON p = replace(title, ' ', '') GROUP BY 1""")
def title_valences(t):
    s = F.col("s_suppkey")
    table = t("supplier").select(at(["PBE_54", "LDA", "OWN"], s).alias("functional"), text("PAW_PBEE", s % 30, "06Sep2000").alias("title"), (s % 3 * 10 + s % 30).cast("double").alias("zval"))
    return headers.valences(t("part").select(text("PAW_PBE E", F.col("p_partkey") % 40, " 06Sep2000").alias("title")), table)


QUERIES, ORACLES = _ALL, _SQL
