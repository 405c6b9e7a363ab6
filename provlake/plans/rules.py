"""Catalog queries: the name, parameter and record rules over many generated values, with SQL that states each rule.

The shared tables hold no file names or parameters.  Each key picks a prefix, a stem and a suffix (or a value of each
parameter), so that all combinations come up; the SQL works the rule out for them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.functions import files, physics, records
from provlake.operators import aggregate as agg
from provlake.operators import fetch, second
from provlake.plans.relational import ORACLES as _SQL
from provlake.plans.relational import QUERIES as _ALL
from provlake.plans.relational import query

PRE = ["", "run/", "a/b/site1_", "my", "x-", "d/._", "__MACOSX/", "s/site1.v2_"]
STEM = ["vasprun", "OUTCAR", "vaspout", "INCAR", "POSCAR", "CONTCAR", "KPOINTS", "CHGCAR", "CHGCAR1", "WAVECAR", "DOSCAR", "notes", "data-raw", "AECCAR0", "vasprun_1"]
SUF = ["", ".xml", ".xml.gz", ".gz", ".zst", ".zip", ".tar.gz", ".7z.001", ".h5", ".z01", ".part1.rar", ".tgz", ".bz2", ".json", ".relax.xz", ".tar.zst", ".rar", ".7z"]


def at(values: list, n, kind: str | None = None):
    """The value that a number's remainder picks."""
    a = F.array(*[F.lit(v) if kind is None else F.lit(v).cast(kind) for v in values])
    return F.get(a, F.pmod(n, F.lit(len(values))).cast("int"))


def sql_at(values: list, n: str) -> str:
    """The same in SQL; lists count from one there."""
    show = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)
    return f"([{', '.join(map(show, values))}])[(({n}) % {len(values)})::INT + 1]"


def name_of(k):
    return F.concat(at(PRE, k), at(STEM, F.floor(k / len(PRE))), at(SUF, F.floor(k / (len(PRE) * len(STEM)))))


def sql_name(k: str) -> str:
    return f"{sql_at(PRE, k)} || {sql_at(STEM, f'({k}) // {len(PRE)}')} || {sql_at(SUF, f'({k}) // {len(PRE) * len(STEM)}')}"


_ALL_STEMS, _PRIMARY, _FETCH = "|".join(files.STEMS), "|".join(files.PRIMARY), "|".join(files.FETCH_STEMS)
_SQUEEZE = r"(\.(gz|bz2|xz|zst|lz4))?$"
_BASE = r"regexp_extract(name, '[^/]*$')"
_HEAVY = " ".join(f"WHEN regexp_matches({_BASE}, '(?i)^{p}') THEN '{k}'" for k, p in files.HEAVY.items())
_ROLE = " ".join(f"WHEN regexp_matches({_BASE}, '(?i)(^|[_.-]){k}{tail}') THEN '{k}'" for k, tail in [("vasprun", r"[\w.-]*\.xml(\.(gz|bz2|xz|zst))?$"), ("vaspout", r"[\w.-]*\.h5$"), *[(r, "") for r in files.ROLES[2:]]])
_ARCHIVE = r"""CASE WHEN l LIKE '%.zip' THEN 'zip' WHEN regexp_matches(l, '\.(tar|tar\.gz|tgz|tar\.bz2|tbz2|tar\.xz|txz)$') THEN 'tar' WHEN l LIKE '%.rar' THEN 'rar' WHEN l LIKE '%.7z' THEN 'sevenzip' WHEN regexp_matches(l, '\.(tar\.zst|tzst)$') THEN 'tarzst' """
NAMES_SQL = rf"""n AS (SELECT k, name, {_BASE} AS base, lower(name) AS l, regexp_matches({_BASE}, '(?i)(^|[_.-])({_FETCH})') AS wanted, CASE {_ROLE} END AS role, CASE {_HEAVY} END AS heavy,
 regexp_extract(lower(name), '(\.tar\.(gz|bz2|xz)|\.[^./]*)$', 1) AS ext, regexp_matches({_BASE}, '(?i)(^|[_.-])({_ALL_STEMS})([._-]\w+)*{_SQUEEZE}') AS calc, regexp_matches({_BASE}, '(?i)(^|[_.-])({_PRIMARY})([._-]\w+)*{_SQUEEZE}') AS prim FROM k)"""


@query(rf"""WITH k AS (SELECT p_partkey AS k, {sql_name('p_partkey')} AS name FROM part), {NAMES_SQL}
SELECT k, name, ext, calc, prim, wanted, regexp_matches(name, '(^|/)(\._|__MACOSX/)') AS junk, regexp_matches(name, '(?i)\.(z\d\d|r\d\d|part\d+\.rar)$') AS multipart,
 {_ARCHIVE} WHEN regexp_matches(l, '\.(zst|gz|bz2|xz)$') AND NOT wanted THEN CASE WHEN l LIKE '%.zst' THEN 'tarzst' ELSE 'tar' END END AS archive, {_ARCHIVE} END AS member_archive, role, heavy FROM n""")
def name_classes(t):
    c = F.col("name")
    return t("part").select(F.col("p_partkey").alias("k"), name_of(F.col("p_partkey")).alias("name")).select(
        "k", "name", files.extension(c).alias("ext"), files.is_calc_name(c).alias("calc"), files.is_primary_name(c).alias("prim"), files.is_fetch_name(c).alias("wanted"), files.is_junk(c).alias("junk"),
        files.is_multipart(c).alias("multipart"), files.archive_kind(c).alias("archive"), files.archive_kind(c, bare=False).alias("member_archive"), files.role(c).alias("role"), files.heavy_kind(c).alias("heavy"),
    )


@query(rf"""WITH k AS (SELECT p_partkey AS k, {sql_name('p_partkey')} AS name FROM part), {NAMES_SQL}, c AS (SELECT *, lower(base) AS b, strpos(lower(base), role) AS i FROM n)
SELECT k, trim(regexp_replace(CASE WHEN role IS NULL THEN b ELSE substr(b, 1, i - 1) || substr(b, i + length(role)) END, '\.(xml|h5|gz|bz2|xz|zst|json)$', ''), ' ._-/') AS tag,
 wanted OR {_ARCHIVE} WHEN regexp_matches(l, '\.(zst|gz|bz2|xz)$') AND NOT wanted THEN 'tar' END IS NOT NULL AS download,
 coalesce(nullif(regexp_replace(regexp_replace(base, '(?i)\.(tar\.gz|tar\.bz2|tar\.xz|tar\.zst|tgz|tbz2|zip|tar|rar|7z|gz|bz2|xz|zst)$', ''), '[^A-Za-z0-9._-]', '_', 'g'), ''), 'archive') AS subdir,
 wanted AND NOT regexp_matches(name, '(^|/)(\._|__MACOSX/)') AND k * 10 <= 9000 AS member FROM c""")
def name_parts(t):
    c, k = F.col("name"), F.col("k")
    return t("part").select(F.col("p_partkey").alias("k"), name_of(F.col("p_partkey")).alias("name")).select(
        "k", files.unit_tag(c).alias("tag"), files.would_download(c).alias("download"), files.archive_subdir(c).alias("subdir"), files.is_wanted_member(c, k * 10, 9000).alias("member")
    )


def _three(k):
    return F.array(name_of(k), name_of(k * 7 + 1), name_of(k * 13 + 5))


_LIST = ", ".join(sql_name(x) for x in ("o_orderkey", "o_orderkey * 7 + 1", "o_orderkey * 13 + 5"))
_HAS = lambda stems: f"list_filter(names, lambda x: regexp_matches(regexp_extract(x, '[^/]*$'), '(?i)(^|[_.-])({stems})([._-]\\w+)*{_SQUEEZE}'))"
_ENDS = lambda ends: "list_filter(names, lambda x: regexp_extract(lower(regexp_extract(x, '[^/]*$')), '(\\.tar\\.(gz|bz2|xz)|\\.[^./]*)$', 1) IN (" + ", ".join(f"'{e}'" for e in ends) + "))"


@query(f"""WITH n AS (SELECT [{_LIST}] AS names FROM orders), c AS (SELECT len({_HAS(_PRIMARY)}) AS p, len({_ENDS(files.ARCHIVES)}) AS a, len({_ENDS(files.PROCESSED)}) AS d, len({_HAS(_ALL_STEMS)}) AS v FROM n),
r AS (SELECT *, CASE WHEN p > 0 THEN 'vasp_direct' WHEN a > 0 THEN 'archive' WHEN d > 0 THEN 'processed_atomistic' WHEN v > 0 THEN 'vasp_input_only' ELSE 'unlikely' END AS category FROM c)
SELECT category, CASE category WHEN 'vasp_direct' THEN 4 WHEN 'archive' THEN 3 WHEN 'processed_atomistic' THEN 2 WHEN 'vasp_input_only' THEN 1 ELSE 0 END AS rank, p, a, d, v, count(*) AS n FROM r GROUP BY ALL""")
def listing_classes(t):
    c = t("orders").select(files.classify(_three(F.col("o_orderkey"))).alias("c"))
    sizes = {"p": "primary_files", "a": "archives", "d": "processed", "v": "vasp_files"}
    return c.groupBy("c.category", "c.rank", *[F.size(f"c.{f}").cast("long").alias(a) for a, f in sizes.items()]).agg(F.count("*").alias("n"))


@query(f"""WITH n AS (SELECT list_filter([{_LIST}], lambda x: NOT regexp_matches(x, '(^|/)(\\._|__MACOSX/)')) AS names FROM orders)
SELECT len({_HAS(_ALL_STEMS)}) AS vasp, len({_HAS(_PRIMARY)}) AS prim, len(list_filter(names, lambda x: regexp_matches(lower(x), '\\.(zip|tar|tar\\.gz|tgz|tar\\.bz2|tbz2|tar\\.xz|txz|rar|7z|tar\\.zst|tzst)$'))) AS nested, count(*) AS n FROM n GROUP BY ALL""")
def archive_hits(t):
    h = t("orders").select(fetch.listing_hits(_three(F.col("o_orderkey"))).alias("h"))
    return h.groupBy(F.size("h.vasp").cast("long").alias("vasp"), F.size("h.primary").cast("long").alias("prim"), F.size("h.nested").cast("long").alias("nested")).agg(F.count("*").alias("n"))


_KIND = lambda k: f"len(list_filter(names, lambda x: regexp_matches(regexp_extract(x, '[^/]*$'), '(?i)^{files.HEAVY[k]}'))) > 0"


@query(f"WITH n AS (SELECT [{_LIST}] AS names FROM orders) SELECT {', '.join(f'{_KIND(k)} AS {k}' for k in files.HEAVY)}, count(*) AS n FROM n GROUP BY ALL")
def heavy_availability(t):
    a = t("orders").select(files.availability(_three(F.col("o_orderkey"))).alias("a"), F.size(fetch.heavy_names(_three(F.col("o_orderkey")))).alias("first"))
    return a.where(F.size(F.map_filter("a", lambda k, v: v)) == F.col("first")).groupBy(*[F.col("a")[k].alias(k) for k in files.HEAVY]).agg(F.count("*").alias("n"))


AEXX, SCREEN, HF, META = [0.0, 0.2, 0.25, 1.0, None], [0.0, 0.2, 0.3, None], [False, True, None], ["", "--", "SCAN", "r2scan", ".FALSE.", "T", "XX", None]
GGA, LDAU, IVDW, VV, PAW = ["PE", "PS", "--", "ZZ", "", None], [False, True, None], [0, 11, 12, 99, None], [False, True], [False, True]
_TURNS = [("a", AEXX, 1), ("s", SCREEN, 5), ("h", HF, 20), ("m", META, 60), ("g", GGA, 480), ("u", LDAU, 2880), ("v", IVDW, 8640), ("w", VV, 43200), ("p", PAW, 86400)]
_CASE = lambda x, table: f"CASE {x} " + " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in table.items())


@query(f"""WITH r AS (SELECT l_orderkey * 7 + l_linenumber * 13 + l_partkey AS k FROM lineitem), x AS (SELECT {', '.join(f'{sql_at(v, f"(k * 7919) // {d}")} AS {n}' for n, v, d in _TURNS)} FROM r),
b AS (SELECT *, CASE WHEN a = 1.0 THEN 'HF' WHEN s = 0.3 THEN 'HSE03' WHEN s = 0.2 THEN 'HSE06' WHEN a = 0.2 THEN 'B3LYP' WHEN h THEN 'PBEO or other Hybrid Functional'
 WHEN m <> '' AND upper(m) NOT IN ('--', 'NONE', 'F', '.FALSE.', '.F.', 'FALSE', 'T', '.TRUE.', '.T.', 'TRUE') THEN {_CASE('upper(m)', physics.METAGGA)} ELSE upper(m) END
 WHEN g <> '' THEN {_CASE('g', physics.GGA)} ELSE g END WHEN p THEN 'LDA' ELSE 'unknown' END AS base FROM x)
SELECT base || CASE WHEN u THEN '+U' ELSE '' END || CASE WHEN w THEN '+rVV10' WHEN v IS NULL THEN '' ELSE '+vdW-' || {_CASE('v', physics.IVDW)} ELSE 'unknown' END END AS run_type, base AS functional,
 base IN ('HSE06', 'HSE03', 'B3LYP', 'HF') OR contains(base, 'Hybrid') AS hybrid, count(*) AS n FROM b GROUP BY ALL""")
def run_types(t):
    k = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")) * 7919
    kinds = dict(zip("ashmguvwp", ["double", "double", "boolean", "string", "string", "boolean", "int", "boolean", "boolean"]))
    x = t("lineitem").select(*[at(v, F.floor(k / d), kinds[n]).alias(n) for n, v, d in _TURNS])
    c = F.col
    run = physics.run_type(c("h"), c("a"), c("s"), c("m"), c("g"), c("u"), c("v"), c("w"), c("p"))
    return x.select(run.alias("run_type")).select("run_type", physics.functional(c("run_type")).alias("functional"), physics.is_hybrid(c("run_type")).alias("hybrid")).groupBy("run_type", "functional", "hybrid").agg(F.count("*").alias("n"))


_RUNS = ["PBE", "HSE06", "HF+U", "PBEO or other Hybrid Functional", "B3LYP+vdW-DFT-D3", "PBE+U"]
_OWN = lambda i, t: f"CASE WHEN NOT blank AND (k // {i + 2}) % 3 = 0 THEN " + (f"{sql_at(['.TRUE.', 'false'], 'k // 5')}" if t == "LHFCALC" else f"'own{i}'") + " END"
_EFF = lambda i, t: f"CASE WHEN (k // {i + 3}) % 4 = 0 THEN " + (f"{sql_at(['true', 'F'], 'k // 7')}" if t == "LHFCALC" else f"'eff{i}'") + " END"
_RESOLVE = " UNION ALL ".join(
    f"""SELECT '{t}' AS tag, {_OWN(i, t)} AS own, {_EFF(i, t)} AS eff, CASE WHEN blank THEN NULL {
    "WHEN hybrid THEN 'true'" if t == "LHFCALC" else "WHEN contains(run, '+U') THEN 'true'" if t == "LDAU" else
    f"WHEN on_ THEN CASE split_part(run, '+', 1) WHEN 'HSE06' THEN '{(0.25, 0.2)[t == 'HFSCREEN']}' WHEN 'HSE03' THEN '{(0.25, 0.3)[t == 'HFSCREEN']}' WHEN 'B3LYP' THEN '{(0.2, 0.0)[t == 'HFSCREEN']}' WHEN 'HF' THEN '{(1.0, 0.0)[t == 'HFSCREEN']}' END" if t in ("AEXX", "HFSCREEN") else ''
    } END AS derived, {f"CASE WHEN NOT blank THEN '{physics.DEFAULTS[t]}' END" if t in physics.DEFAULTS else 'NULL'} AS dflt, {'NOT blank AND NOT on_' if t in ('AEXX', 'HFSCREEN') else 'false'} AS moot FROM s"""
    for i, t in enumerate(physics.TAGS)
)


@query(f"""WITH k AS (SELECT o_orderkey AS k, o_orderkey % 5 = 0 AS blank, {sql_at(_RUNS, 'o_orderkey // 3')} AS run FROM orders),
h AS (SELECT *, split_part(run, '+', 1) IN ('HSE06', 'HSE03', 'B3LYP', 'HF') OR contains(run, 'Hybrid') AS hybrid, {_OWN(0, 'LHFCALC')} AS o, {_EFF(0, 'LHFCALC')} AS e FROM k),
s AS (SELECT *, upper(coalesce(o, e, CASE WHEN NOT blank AND hybrid THEN 'true' END, 'false')) IN ('T', '.TRUE.', '.T.', 'TRUE', '1') AS on_ FROM h), r AS ({_RESOLVE})
SELECT tag, coalesce(own, eff, derived, dflt) AS value, CASE WHEN own IS NOT NULL THEN 'incar' WHEN eff IS NOT NULL THEN 'parameters' WHEN derived IS NOT NULL THEN 'derived:run_type' WHEN dflt IS NOT NULL THEN 'default' WHEN moot THEN 'not_applicable' ELSE 'unknown' END AS source, count(*) AS n FROM r GROUP BY ALL""")
def resolved_tags(t):
    k = F.col("o_orderkey")
    own, eff = [], []
    for i, tag in enumerate(physics.TAGS):
        on = F.when(F.pmod(F.floor(k / (i + 2)), F.lit(3)) == 0, at([".TRUE.", "false"], F.floor(k / 5)) if tag == "LHFCALC" else F.lit(f"own{i}"))
        by = F.when(F.pmod(F.floor(k / (i + 3)), F.lit(4)) == 0, at(["true", "F"], F.floor(k / 7)) if tag == "LHFCALC" else F.lit(f"eff{i}"))
        own += [F.lit(tag), on]
        eff += [F.lit(tag), by]
    incar = F.when(k % 5 != 0, F.create_map(*own))
    maps = t("orders").select(incar.alias("incar"), F.create_map(*eff).alias("parameters"), at(_RUNS, F.floor(k / 3)).alias("run_type"))
    got = maps.select(physics.resolve_all(F.col("incar"), F.col("parameters"), F.col("run_type")).alias("m")).select(F.explode("m").alias("tag", "r"))
    return got.groupBy("tag", "r.value", "r.source").agg(F.count("*").alias("n"))


@query("""SELECT tag, source, count(*) AS n FROM (SELECT unnest(['LREAL', 'NKRED']) AS tag, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE 'default' END AS source FROM orders) GROUP BY ALL
UNION ALL SELECT 'stress', CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE 'derived:stress' END, count(*) FROM orders GROUP BY ALL""")
def tier_matrix(t):
    from provlake.operators.dataset import enrich

    k = F.col("o_orderkey")
    empty = F.create_map().cast("map<string,string>")
    block = F.struct(F.when(k % 3 != 0, empty).alias("incar"), empty.alias("parameters"), F.lit("PBE").alias("run_type"))
    rows = enrich(t("orders").select(k.alias("calc_id"), block.alias("calc_parameters"), F.struct(F.when(k % 4 != 0, k % 2).alias("n_frames_with_stress")).alias("quality")))
    tags = agg.pivot_sources(rows, "resolved").where("tag in ('LREAL', 'NKRED')")
    return tags.unionByName(rows.groupBy(F.lit("stress").alias("tag"), F.col("computes_stress.source").alias("source")).agg(F.count("*").alias("n")))


TOKENS = ["T", ".TRUE.", "TRUE", ".f.", "12", "-3", "1.5", "1.5D-3", "1.E-8", "-.1E-04", "Normal", "", "F", "0", "1e3", "x1"]


@query(f"""WITH v AS (SELECT o_orderkey, {sql_at(TOKENS, 'o_orderkey')} AS t FROM orders), c AS (SELECT t, CASE WHEN upper(t) IN ('T', '.T.', '.TRUE.') THEN true WHEN upper(t) IN ('F', '.F.', '.FALSE.') THEN false END AS b, TRY_CAST(translate(upper(t), 'D', 'E') AS DOUBLE) AS d FROM v)
SELECT t AS token, CASE WHEN b IS NOT NULL THEN 'boolean' WHEN regexp_matches(t, '^[-+]?[0-9]+$') THEN 'integer' WHEN d IS NOT NULL THEN 'decimal' ELSE 'text' END AS kind, b, d, upper(t) IN ('T', '.TRUE.', '.T.', 'TRUE', '1') AS on_, count(*) AS n FROM c GROUP BY ALL""")
def token_kinds(t):
    x = t("orders").select(at(TOKENS, F.col("o_orderkey")).alias("token"))
    c = x.select("token", physics.coerce(F.col("token")).alias("c"), physics.truthy(F.col("token")).alias("on_"))
    return c.groupBy("token", "c.kind", "c.b", "c.d", "on_").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN n <= 1 OR s IS NULL THEN CASE WHEN s IS NULL THEN NULL ELSE true END WHEN (m = 0 OR (m IN (1, 2) AND e = 0)) THEN s = n ELSE s < n END AS v, count(*) AS c FROM
 (SELECT coalesce(n0, 0) AS n, coalesce(m0, CASE WHEN coalesce(n0, 0) IN (-1, 0) THEN -1 ELSE 0 END) AS m, e, s FROM (SELECT ([0, 1, 10, 25, -1, NULL])[(l_orderkey % 6)::INT + 1] AS n0, ([0, 1, 2, 3, -1, NULL])[(l_partkey % 6)::INT + 1] AS m0, ([0.0, -0.01, 0.001, NULL])[(l_suppkey % 4)::INT + 1] AS e, ([1, 5, 10, 25, NULL])[(l_linenumber % 5)::INT + 1] AS s FROM lineitem)) GROUP BY 1""")
def ionic_matrix(t):
    c = F.col
    v = physics.ionic_converged(at([0, 1, 10, 25, -1, None], c("l_orderkey"), "int"), at([0, 1, 2, 3, -1, None], c("l_partkey"), "int"), at([0.0, -0.01, 0.001, None], c("l_suppkey"), "double"), at([1, 5, 10, 25, None], c("l_linenumber"), "int"))
    return t("lineitem").groupBy(v.alias("v")).agg(F.count("*").alias("c"))


@query("""WITH x AS (SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS got, o_orderkey % 3 = 0 AS tr, o_orderkey % 5 = 0 AS cut, o_orderkey % 7 AS units, o_orderkey % 11 = 0 AS def FROM orders),
r AS (SELECT *, CASE WHEN def THEN 'disk_budget_deferred' WHEN NOT got OR units = 0 THEN CASE WHEN cut THEN 'record_exceeds_disk_budget' WHEN tr THEN 'fetch_failed_transient' WHEN NOT got THEN 'no_vasp_files_fetched' ELSE 'no_calc_units_after_extract' END END AS reason FROM x)
SELECT reason, reason IS NULL AS kept, CASE WHEN reason IS NULL AND cut THEN 'record_exceeds_disk_budget' END AS note, tr AND NOT cut AND units > 0 AS stays, count(*) AS n FROM r GROUP BY ALL""")
def fetch_verdicts(t):
    k = F.col("o_orderkey")
    tr, cut, units = k % 3 == 0, k % 5 == 0, k % 7
    v = t("orders").select(fetch.verdict(k % 11 == 0, k % 2 == 0, tr, cut, units).alias("v"), fetch.keep_staging(tr, cut, units).alias("stays"))
    return v.groupBy("v.reason", "v.kept", "v.note", "stays").agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT ([200, 206, 404, 416, 429, 503])[(o_orderkey % 6)::INT + 1] AS st, (o_orderkey // 6) % 2 * 100 AS have, (o_orderkey // 12) % 5 AS try_, (o_orderkey // 60) % 3 = 0 AS cap, (o_orderkey // 7) % 4 = 0 AS full_, (o_orderkey // 11) % 9 <> 0 AS md5, CASE WHEN o_orderkey % 13 = 0 THEN 'write_error:OSError' END AS err FROM orders),
r AS (SELECT *, CASE WHEN full_ THEN 'disk_budget_reached' WHEN st >= 400 THEN 'http_' || st WHEN cap THEN 'over_size_cap' WHEN err IS NOT NULL THEN err WHEN NOT md5 THEN 'md5_mismatch' ELSE 'ok' END AS reason FROM x)
SELECT reason, CASE WHEN reason = 'ok' THEN 'ok' WHEN regexp_matches(reason, '^(download_error|write_error|http_5|http_429|disk_budget)') THEN 'transient' ELSE 'failed' END AS kind,
 CASE WHEN st = 206 AND have > 0 THEN 'append' WHEN st < 300 THEN 'restart' WHEN st = 416 AND have > 0 THEN 'verify' WHEN st = 429 AND try_ < 3 THEN 'wait' ELSE 'reject' END AS step, count(*) AS n FROM r GROUP BY ALL""")
def download_outcomes(t):
    k = F.col("o_orderkey")
    turn = lambda d, m: F.pmod(F.floor(k / d), F.lit(m))
    st = at([200, 206, 404, 416, 429, 503], k)
    reason = fetch.outcome(F.lit(True), st, F.when(k % 13 == 0, "write_error:OSError"), turn(60, 3) == 0, turn(7, 4) == 0, turn(11, 9) != 0)
    x = t("orders").select(reason.alias("reason"), fetch.resume_step(turn(6, 2) * 100, st, turn(12, 5)).alias("step"))
    return x.groupBy("reason", fetch.reason_kind(F.col("reason")).alias("kind"), "step").agg(F.count("*").alias("n"))


@query("SELECT least(coalesce(CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 200)::DOUBLE END, pow(2.0, o_orderkey % 8 + 1)), 120.0) AS wait, least(pow(2.0, o_orderkey % 8 + 1), 60.0) AS backoff, count(*) AS n FROM orders GROUP BY 1, 2")
def waiting(t):
    k = F.col("o_orderkey")
    said = F.when(k % 3 == 0, (k % 200).cast("string")).when(k % 3 == 1, "soon")
    return t("orders").groupBy(fetch.wait_seconds(said, k % 8).alias("wait"), records.backoff_seconds(k % 8).alias("backoff")).agg(F.count("*").alias("n"))


MAIN, REMOTE = ["up/calc1/vasprun.xml", "vasprun.xml.gz", "up/OUTCAR", "up/x/GEO_vasprun.xml.bz2", "up/x/notes.txt"], ["up/calc1/OUTCAR", "up/calc1/sub/CHGCAR.gz", "other/OUTCAR.xz", "vasprun.relax.xml.bz2", "top.txt", "up/x/POSCAR"]
_ROLE2 = lambda p: f"CASE WHEN regexp_matches(regexp_extract({p}, '[^/]*$'), '(?i)vasprun.*\\.xml') THEN 'vasprun' WHEN regexp_matches(regexp_extract({p}, '[^/]*$'), '(?i)(^|[_.-])outcar') THEN 'outcar' END"


@query(rf"""WITH x AS (SELECT {sql_at(MAIN, 'o_orderkey')} AS m, {sql_at(REMOTE, 'o_orderkey // 5')} AS p, {sql_at(REMOTE, 'o_orderkey // 30')} AS q FROM orders), y AS (SELECT *, regexp_extract(m, '^(.*)/[^/]*$', 1) || '/' AS d, {_ROLE2('m')} AS rm, {_ROLE2('p')} AS rp, {_ROLE2('q')} AS rq FROM x)
SELECT m, p, q, CASE WHEN d <> '/' AND starts_with(p, d) THEN substr(p, length(d) + 1) ELSE regexp_extract(p, '[^/]*$') END AS rel, CASE WHEN rp = 'vasprun' THEN 'vasprun.xml' ELSE 'OUTCAR' END || regexp_extract(lower(p), '(\.gz|\.bz2|\.xz)$', 1) AS staged,
 CASE WHEN rm IS NOT NULL THEN m WHEN rp = 'vasprun' THEN p WHEN rq = 'vasprun' THEN q WHEN rp = 'outcar' THEN p WHEN rq = 'outcar' THEN q END AS pick, CASE WHEN rm IS NOT NULL THEN rm WHEN 'vasprun' IN (rp, rq) THEN 'vasprun' WHEN 'outcar' IN (rp, rq) THEN 'outcar' END AS role, count(*) AS n FROM y GROUP BY ALL""")
def entry_paths(t):
    k = F.col("o_orderkey")
    x = t("orders").select(at(MAIN, k).alias("m"), at(REMOTE, F.floor(k / 5)).alias("p"), at(REMOTE, F.floor(k / 30)).alias("q"))
    m, p, q = F.col("m"), F.col("p"), F.col("q")
    c = second.choose_primary(m, F.array(p, q))
    return x.groupBy("m", "p", "q", second.relative_to_main(p, m).alias("rel"), second.staged_name(p, F.coalesce(second.entry_role(p), F.lit(""))).alias("staged"), c["path"].alias("pick"), c["role"].alias("role")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, 'u' || (c_custkey % 7) AS upload_id, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 4 END AS refs, (c_custkey % 5 > 0)::INT AS dois, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'VASP' END AS program FROM customer""")
def slim_entries(t):
    k = F.col("c_custkey")
    doi = lambda x: F.struct(x.alias("doi"), F.lit("big").alias("rest"))
    method = F.when(k % 11 != 0, F.struct(F.lit("DFT").alias("method_name"), F.struct(F.lit("VASP").alias("program_name"), F.lit("6").alias("program_version"), F.struct(F.array(F.lit("GGA")).alias("xc_functional_names")).alias("dft")).alias("simulation")))
    entry = F.struct(
        k.cast("string").alias("entry_id"), F.concat(F.lit("u"), (k % 7).cast("string")).alias("upload_id"), F.lit("m").alias("mainfile"), F.lit(None).cast("string").alias("external_db"), F.lit(None).cast("string").alias("external_id"), F.lit("CC BY 4.0").alias("license"),
        F.when(k % 3 != 0, F.array_repeat(F.lit("r"), (k % 4).cast("int"))).alias("references"), F.when(k % 5 > 0, F.array(doi(F.concat(F.lit("10.1/"), k.cast("string"))), doi(F.lit(None).cast("string")))).alias("datasets"),
        F.array(F.struct(F.lit("A").alias("name"), F.lit(1).alias("id"))).alias("authors"), F.lit("2024").alias("upload_create_time"),
        F.struct(F.struct(F.array(F.lit("H")).alias("elements"), F.lit("H").alias("chemical_formula_reduced")).alias("material"), method.alias("method"), F.struct(F.lit(None).cast("array<string>").alias("available_properties")).alias("properties")).alias("results"),
    )
    s = t("customer").select("c_custkey", second.slim(entry).alias("s"))
    return s.select("c_custkey", "s.upload_id", F.size("s.references").alias("refs"), F.size("s.datasets").alias("dois"), F.col("s.results.method.simulation.program_name").alias("program"))


@query("""WITH e AS (SELECT c_custkey, c_custkey % 50 AS u, 'd' || (c_custkey % 20) || CASE WHEN c_custkey % 3 = 0 THEN '/OUTCAR' WHEN c_custkey % 3 = 1 THEN '/vasprun.xml' ELSE '/x.txt' END AS f FROM customer),
m AS (SELECT s_suppkey AS pos, s_suppkey % 50 AS u, 'd' || (s_suppkey % 20) || CASE WHEN s_suppkey % 2 = 0 THEN '/OUTCAR' ELSE '/vasprun.xml' END || CASE WHEN s_suppkey % 5 = 0 THEN '.' || (s_suppkey % 3) ELSE '' END AS name FROM supplier),
own AS (SELECT c_custkey, e.u, f FROM e WHERE NOT f LIKE '%.txt' AND EXISTS (SELECT 1 FROM m WHERE m.u = e.u AND m.name = f)),
sib AS (SELECT u, split_part(name, '/', 1) AS d, arg_min(name, pos) AS name FROM m WHERE name LIKE '%/OUTCAR%' GROUP BY 1, 2)
SELECT u AS upload_id, c_custkey AS entry_id, f AS name, CASE WHEN f LIKE '%OUTCAR' THEN 'outcar' ELSE 'vasprun' END AS role FROM own
UNION ALL SELECT own.u, c_custkey, sib.name, 'outcar' FROM own JOIN sib ON sib.u = own.u AND sib.d = split_part(f, '/', 1) WHERE f LIKE '%vasprun.xml'""")
def archive_members(t):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    e = t("customer").select((k % 50).alias("upload_id"), k.alias("entry_id"), F.concat(F.lit("d"), (k % 20).cast("string"), at(["/OUTCAR", "/vasprun.xml", "/x.txt"], k)).alias("mainfile"))
    m = t("supplier").select((s % 50).alias("upload_id"), F.concat(F.lit("d"), (s % 20).cast("string"), at(["/OUTCAR", "/vasprun.xml"], s), F.when(s % 5 == 0, F.concat(F.lit("."), (s % 3).cast("string"))).otherwise("")).alias("name"), s.alias("pos"))
    return second.wanted_members(e, m)


@query(f"""WITH n AS (SELECT o_orderkey, [{_LIST}] AS names, o_orderkey % 4 = 0 AS dos, o_orderkey % 6 = 0 AS band FROM orders)
SELECT dos OR {_KIND('dos')} AS dos, band OR {_KIND('eigenvalues')} AS eigenvalues, {_KIND('charge_density')} AS charge_density, count(*) AS n FROM n GROUP BY ALL""")
def entry_availability(t):
    k = F.col("o_orderkey")
    props = F.filter(F.array(F.when(k % 4 == 0, "dos_electronic"), F.when(k % 6 == 0, "band_structure_electronic"), F.lit("geometry_optimization")), lambda x: x.isNotNull())
    a = t("orders").select(second.availability(F.when(k % 9 != 1, props).otherwise(props), _three(k)).alias("a"))
    return a.groupBy(*[F.col("a")[x].alias(x) for x in ("dos", "eigenvalues", "charge_density")]).agg(F.count("*").alias("n"))


QUERIES, ORACLES = _ALL, _SQL
