"""Catalog queries: the record and parameter rules on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import files, physics, records
from provlake.operators import aggregate as agg
from provlake.operators import dataset as ds
from provlake.plans.relational import QUERIES as _ALL
from provlake.plans.relational import ORACLES as _SQL
from provlake.plans.relational import query


@query("""SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN l_linenumber <= 1 THEN true WHEN l_linenumber = 2 AND l_quantity < 25 THEN true WHEN l_linenumber = 2 THEN false ELSE l_quantity < l_linenumber * 10 END AS verdict FROM lineitem) GROUP BY 1""")
def ionic_rule(t):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    nsw = F.when(n <= 1, 1).when(n == 2, 25).otherwise(n * 10)
    v = physics.ionic_converged(nsw, F.lit(2), F.lit(-0.01), q)
    return t("lineitem").select(v.alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n"))


@query("""SELECT ok, count(*) AS n FROM (SELECT coalesce(trim(lower(o_orderpriority)) NOT IN ('', 'none') AND NOT list_has_any(regexp_split_to_array(trim(lower(o_orderpriority)), '[-_.\\s]+'), ['nc', 'nd']), false) AS ok FROM orders) GROUP BY 1""")
def licence_gate(t):
    return t("orders").groupBy(records.reusable_licence(F.col("o_orderpriority")).alias("ok")).agg(F.count("*").alias("n"))


@query("SELECT regexp_extract(lower(url), '(\\.tar\\.(gz|bz2|xz)|\\.[^./]*)$', 1) AS ext, count(*) AS n FROM pages GROUP BY 1")
def extensions(t):
    return t("pages").groupBy(files.extension(F.col("url")).alias("ext")).agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN p_size <= 10 THEN 'integer' WHEN p_size <= 20 THEN 'decimal' WHEN p_size <= 30 THEN 'boolean' ELSE 'text' END AS kind, count(*) AS n FROM part GROUP BY 1")
def coerce_tokens(t):
    s = F.col("p_size")
    tok = F.when(s <= 10, s.cast("string")).when(s <= 20, F.concat(s.cast("string"), F.lit(".5D-3"))).when(s <= 30, ".TRUE.").otherwise("Normal")
    return t("part").groupBy(physics.coerce(tok)["kind"].alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT c_mktsegment AS key, CASE WHEN bool_and(c_acctbal > 0) THEN 'purge' WHEN bool_or(c_acctbal > 0) THEN 'partial' ELSE 'keep' END AS action, count(*) FILTER (c_acctbal > 0) AS free_files FROM customer GROUP BY 1")
def purge_decision(t):
    c = t("customer").select(F.col("c_mktsegment").alias("recid"), F.col("c_custkey").cast("string").alias("calc_id"), F.create_map(F.lit("vasprun"), F.col("c_custkey").cast("string")).alias("files"), "c_acctbal")
    return ds.purge_plan(c, c.where("c_acctbal > 0")).select(F.col("recid").alias("key"), "action", "free_files")


@query("SELECT conv_id AS calc_id, count(*) AS n_frames, count(*) FILTER (role <> 'user') AS n_frames_scf_unconverged, arg_max(role = 'user', turn) AS electronic_converged FROM conversations GROUP BY 1")
def calc_quality(t):
    c = t("conversations").select(F.col("conv_id").alias("calc_id"), F.col("turn").alias("ionic_step"), (F.col("role") == "user").alias("electronic_converged"), F.lit(None).cast("string").alias("forces"), F.lit(0.0).alias("e_free"), F.lit(0.0).alias("ref_energy"), F.lit(1).alias("n_atoms"))
    return agg.calc_quality(c).select("calc_id", "n_frames", "n_frames_scf_unconverged", "electronic_converged")


QUERIES, ORACLES = _ALL, _SQL
