"""Catalog queries: names, listings, units, archives, ancestors, verdicts and audits on the shared tables.

The tables hold no file names, so names and texts are built from keys; the SQL states what each must give.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import physics, records
from provlake.operators import aggregate as agg
from provlake.operators import dataset as ds
from provlake.operators import keys, report
from provlake.plans.relational import ORACLES as _SQL
from provlake.plans.relational import QUERIES as _ALL
from provlake.plans.relational import query


def pick(key: str, values: list):
    """One of ``values`` by the key's remainder."""
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values)).cast("int"))


@query("SELECT CASE WHEN o_orderkey % 7 <> 0 THEN '10.' || (1000 + o_custkey % 50) || '/abc.' || (o_orderkey % 10) END AS doi, count(*) AS n FROM orders GROUP BY 1")
def doi_rules(t):
    text = F.when(F.col("o_orderkey") % 7 == 0, "no id").otherwise(F.format_string("https://doi.org/10.%d/ABC.%d..", 1000 + F.col("o_custkey") % 50, F.col("o_orderkey") % 10))
    return t("orders").groupBy(records.normal_doi(text).alias("doi")).agg(F.count("*").alias("n"))


@query("""SELECT reason, reason IN ('download_error:x', 'http_503', 'disk_budget') AS transient, reason = 'no_vasp_files_fetched' AS fetch_end, reason = 'no_frames' AS parse_end, count(*) AS n FROM
 (SELECT (['download_error:x', 'http_503', 'no_frames', 'no_vasp_files_fetched', 'http_404', 'disk_budget'])[(o_orderkey % 6)::INT + 1] AS reason FROM orders) GROUP BY ALL""")
def reason_kinds(t):
    got = t("orders").groupBy(pick("o_orderkey", ["download_error:x", "http_503", "no_frames", "no_vasp_files_fetched", "http_404", "disk_budget"]).alias("reason")).agg(F.count("*").alias("n"))
    r = F.col("reason")
    return got.select(r, records.transient(r).alias("transient"), records.terminal_fetch(r).alias("fetch_end"), records.terminal_parse(r).alias("parse_end"), "n")


@query("SELECT (20 - l_quantity) / l_linenumber > -15 AND (20 - l_quantity) / l_linenumber < 8 AS sane, count(*) AS n FROM lineitem GROUP BY 1")
def label_sanity(t):
    energy = 20 - F.col("l_quantity").cast("double")
    return t("lineitem").groupBy(ds.sane_labels(energy, F.col("l_linenumber")).alias("sane")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey % 3 = 0 AND p_size > 10 AND p_partkey % 5 <> 0 AND p_partkey % 2 = 0 AS keep, count(*) AS n FROM part GROUP BY 1")
def keep_query(t):
    k = F.col("p_partkey")
    elements = F.when(k % 2 == 0, F.array(F.lit("O"), F.lit("Fe"), F.lit("H"))).otherwise(F.array(F.lit("Fe")))
    keep = records.keep_entry(F.when(k % 3 == 0, "VASP").otherwise("QE"), F.when(F.col("p_size") > 10, "DFT").otherwise("GW"), F.when(k % 5 == 0, "AFLOW"), elements, ["Fe", "O"])
    return t("part").groupBy(keep.alias("keep")).agg(F.count("*").alias("n"))


def _paths(t):
    k = F.col("o_orderkey")
    return t("orders").select(F.format_string("d%d/e%d/f%d/x%d", k % 3, k % 4, k % 5, k).alias("path"))


@query("""SELECT CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 4 = 2 AND o_orderkey % 5 = 3 THEN 'parsed' WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 = 1 THEN 'pending' WHEN o_orderkey % 3 = 0 THEN 'kept' END AS status, count(*) AS n FROM orders GROUP BY 1""")
def nearest_status(t):
    p = _paths(t)
    dirs = p.sparkSession.createDataFrame([("d0", "kept"), ("d0/e1", "pending"), ("d1/e2/f3", "parsed")], "dir string, status string")
    return ds.nearest_ancestor(p, dirs, "status").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT 'd' || (o_orderkey % 3) || '/e' || (o_orderkey % 4) || '/f' || (o_orderkey % 5) || '/x' || o_orderkey AS path FROM orders WHERE o_orderkey % 3 <> 0")
def reclaim_paths(t):
    p = _paths(t)
    return ds.reclaimable(p, p.sparkSession.createDataFrame([("d0", True), ("d0/e1", False), ("d1/e2", False)], "dir string, keep boolean"))


@query("""SELECT l_orderkey AS recid, CASE WHEN bool_or(l_returnflag = 'R') THEN 'confirmed' WHEN bool_and(l_linestatus = 'F' AND l_linenumber <= 5) THEN 'negative' ELSE 'gap' END AS verdict FROM lineitem GROUP BY 1""")
def peek_verdicts(t):
    a = t("lineitem").select(F.col("l_orderkey").alias("recid"), (F.col("l_returnflag") == "R").alias("has_names"), (F.col("l_linestatus") == "F").alias("readable"), (F.col("l_linenumber") > 5).alias("nested"))
    return ds.peek_verdict(a)


@query("""SELECT archive, targets, total, skipped, CASE WHEN targets = 0 THEN 'proven_empty' WHEN targets > 128 THEN 'whole_many' WHEN skipped >= 50000000 THEN 'targeted' ELSE 'whole_small' END AS plan FROM
 (SELECT l_suppkey AS archive, count(*) FILTER (l_linenumber = 1) AS targets, sum(l_quantity::BIGINT * 1000)::BIGINT AS total, coalesce(sum(l_quantity::BIGINT * 1000) FILTER (l_linenumber <> 1), 0)::BIGINT AS skipped FROM lineitem GROUP BY 1)""")
def zip_plans(t):
    m = t("lineitem").select(F.col("l_suppkey").alias("archive"), F.when(F.col("l_linenumber") == 1, "OUTCAR").otherwise("notes.txt").alias("name"), F.lit(False).alias("zip64"), (F.col("l_quantity").cast("long") * 1000).alias("compressed_size"))
    return ds.zip_plan(m).select("archive", "targets", "total", "skipped", "plan")


@query("""SELECT upload, n, wanted, span, CASE WHEN n <= 256 OR wanted <= 0 OR greatest((ceil(n / 256) + 1) * 5.0::DOUBLE, wanted / 2000000) <= 5.0::DOUBLE + span / 2000000 THEN 'targeted' ELSE 'whole' END AS plan FROM
 (SELECT l_suppkey AS upload, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS wanted, (max(l_orderkey * 1000 + 548 + l_quantity::BIGINT) - min(l_orderkey * 1000))::BIGINT AS span FROM lineitem GROUP BY 1)""")
def stream_plans(t):
    m = t("lineitem").select(F.col("l_suppkey").alias("upload"), (F.col("l_orderkey").cast("long") * 1000).alias("offset"), F.lit("OUTCAR").alias("name"), F.col("l_quantity").cast("long").alias("compressed_size"))
    return ds.stream_plan(m, "upload", 2e6, 5.0).select("upload", "n", "wanted", "span", "plan")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def last_seen(t):
    return keys.last_seen(t("events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT 'medium' AS flag, count(*) AS n FROM documents WHERE n_chars > 500 HAVING count(*) > 0 UNION ALL SELECT 'long', count(*) FROM documents WHERE n_chars > 2000 HAVING count(*) > 0")
def flag_union(t):
    a = F.create_map(F.lit("medium"), F.col("n_chars") > 500)
    b = F.create_map(F.lit("medium"), F.lit(None).cast("boolean"), F.lit("long"), F.col("n_chars") > 2000)
    return agg.true_flags(t("documents").select(keys.or_flags(a, b).alias("f")), "f")


@query("""SELECT CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 5 < 3 END AS converged, CASE o_orderkey % 5 WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 WHEN 3 THEN 0.25 WHEN 4 THEN 0.125 END::DOUBLE AS de, count(*) AS n FROM orders GROUP BY 1, 2""")
def scf_rules(t):
    steps = F.slice(F.array(F.lit(1.0), F.lit(-0.5), F.lit(0.25), F.lit(-0.125)), F.lit(1), (F.col("o_orderkey") % 5).cast("int"))
    return t("orders").select(physics.scf_verdict(steps, F.lit(3)).alias("v")).groupBy("v.converged", "v.de").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN p_size * 4 + 12 END::DOUBLE AS neutral, CASE WHEN p_partkey % 10 <> 0 THEN p_size * 4 + 12 - p_partkey % 20 END::DOUBLE AS charge, (p_size + 0.5)::DOUBLE AS moment FROM part""")
def electron_counts(t):
    k, size = F.col("p_partkey"), F.col("p_size")
    neutral = physics.neutral_electrons(F.array(size.cast("double"), F.lit(2.0)), F.when(k % 10 == 0, F.array(F.lit(4.0))).otherwise(F.array(F.lit(4.0), F.lit(6.0))))
    text = F.format_string("number of electron 10.0 magnetization 0.1\nnumber of electron 10.0 magnetization %d.5\n", size)
    return t("part").select("p_partkey", neutral.alias("neutral"), physics.net_charge(neutral, (k % 20).cast("double")).alias("charge"), physics.moment(physics.last_magnetisation(text)).alias("moment"))


@query("SELECT p_partkey, (p_size * 10)::VARCHAR AS encut, '0.1' AS sigma, 3 AS n FROM part")
def parameter_map(t):
    m = physics.parameter_lines(F.format_string("encut = %d ! c\nISMEAR=0; sigma = 0.1\nENCUT=1\n# X = 2", F.col("p_size") * 10))
    return t("part").select("p_partkey", m.alias("m")).select("p_partkey", F.col("m")["ENCUT"].alias("encut"), F.col("m")["SIGMA"].alias("sigma"), F.size("m").alias("n"))


@query("""SELECT p_partkey AS recid, 'run' AS dir, '' AS unit, 2 + (p_partkey % 3 = 0)::INT AS n_files FROM part UNION ALL SELECT p_partkey, 'run', 'a', 2 FROM part WHERE p_partkey % 5 = 0""")
def unit_groups(t):
    k = F.col("p_partkey")
    names = F.filter(F.array(F.lit("run/OUTCAR"), F.lit("run/INCAR"), F.when(k % 3 == 0, "run/vasprun.xml"), F.when(k % 5 == 0, "run/OUTCAR_a")), lambda x: x.isNotNull())
    return ds.group_units(t("part").select(k.alias("recid"), F.explode(names).alias("path"))).select("recid", "dir", "unit", F.size("files").alias("n_files"))


@query("""WITH s AS (SELECT o_orderpriority p, sum(round(o_totalprice)::BIGINT) v, count(*) s FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), w AS (SELECT o_orderpriority p, count(*) w FROM orders GROUP BY 1)
SELECT round(sum(v * (w::DOUBLE / s)) / 1000, 1) AS estimate FROM s JOIN w USING (p)""")
def extrapolated_total(t):
    o = t("orders").select("o_orderpriority", "o_orderstatus", F.round("o_totalprice").cast("long").alias("v"), F.lit(1).alias("size"))
    whole = o.groupBy("o_orderpriority").agg(F.sum("size").alias("size"))
    return agg.extrapolate(o.where("o_orderstatus = 'F'"), whole, "o_orderpriority", "v", "size").select(F.round(F.col("estimate") / 1000, 1).alias("estimate"))


@query("""SELECT o_custkey AS recid, count(*) AS expected, count(l) AS parsed, count(*) FILTER (l IS NULL AND o_orderstatus = 'F') AS rejected, count(*) FILTER (l IS NULL AND o_orderstatus <> 'F') AS unaccounted FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON l = o_orderkey GROUP BY 1""")
def audit_records(t):
    o = t("orders").select(F.col("o_custkey").alias("recid"), F.col("o_orderkey").alias("calc_id"), "o_orderstatus")
    return report.audit(o.drop("o_orderstatus"), t("lineitem").select(F.col("l_orderkey").alias("calc_id")), o.where("o_orderstatus = 'F'").select(F.col("calc_id").alias("id")))


@query("SELECT page_id, 'doi' AS reason FROM pages WHERE page_id % 10 = 3")
def reference_overlap(t):
    p = t("pages").select("page_id", F.array(F.lit("no reference"), F.format_string("https://doi.org/10.1234/X%d.", F.col("page_id") % 10)).alias("refs"))
    return keys.overlap_reason(p, p.sparkSession.createDataFrame([("10.1234/x3",)], "doi string"), "page_id", "refs")


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def prune_frames(t):
    calcs = t("orders").where("o_orderstatus = 'F'").select(F.array("o_orderkey").alias("frame_ids"))
    return ds.prune_uncommitted(t("lineitem").select(F.col("l_orderkey").alias("frame_id"), "l_returnflag"), calcs).groupBy("l_returnflag").agg(F.count("*").alias("n"))


QUERIES, ORACLES = _ALL, _SQL
