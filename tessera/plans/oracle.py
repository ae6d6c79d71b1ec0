"""Independent SQL (DuckDB dialect) for every oracle-checked query.

Written the way the reference computes things -- one aggregate and one left
join per feature group -- so it checks the fused Spark plan rather than
mirroring it.  Only the binding's value encodings are shared.
"""
from __future__ import annotations

from tessera.functions.hashing import hash_u32_sql as hash_u32_sql_, hash_unit_sql
from tessera.functions.scalars import COUNTRY_RULES, TARGET_DEFAULT, TARGET_RULES
from tessera.ml import evaluate as E
from tessera.plans import binding as B
from tessera.plans.master import REPORT_COLUMNS

SQL: dict[str, str] = {}


def lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def rnd(sql: str, cols: list[str]) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q"


def rules_sql(expr: str, rules, default) -> str:
    parts = [f"WHEN {expr} IS NULL THEN NULL"]
    for kws, out in rules:
        cond = " OR ".join(f"contains(lower({expr}), {lit(k)})" for k in kws)
        parts.append(f"WHEN {cond} THEN {lit(out)}")
    return "CASE " + " ".join(parts) + f" ELSE {lit(default)} END"


FINAL_SQL = B.case_sql(B.FINAL_RESULT_CASES, default="o_orderpriority")
ORDERS_VIEW = (f"SELECT o_orderkey AS report_id, o_custkey AS client_id, o_orderdate AS report_date, "
               f"o_orderstatus AS product_name, {FINAL_SQL} AS final_result FROM orders")
CLIENT_DIM = (f"SELECT c.c_custkey AS client_id, c.c_mktsegment AS client_std_name, "
              f"nullif(c.c_nationkey, {B.NULL_MANUFACTURER}) AS manu_id, n.n_name AS manu_add "
              f"FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
SHEET = ("SELECT s.s_nationkey AS manu_id, r.r_name AS country, CAST(s.s_suppkey AS BIGINT) AS _order FROM supplier s "
         "LEFT JOIN region r ON s.s_suppkey % 5 = r.r_regionkey")
LOOKUP = (f"SELECT manu_id, country FROM (SELECT *, row_number() OVER (PARTITION BY manu_id ORDER BY _order) AS first "
          f"FROM ({SHEET}) s) f WHERE first = 1")
REPORT_BASE = f"""
SELECT o.report_id, o.report_date, o.product_name, o.final_result, o.client_id, c.client_std_name, c.manu_id,
       mn.n_name AS manu_std_name,
       CASE WHEN c.manu_id IS NULL THEN c.manu_add ELSE lk.country END AS manu_add
FROM ({ORDERS_VIEW}) o
LEFT JOIN ({CLIENT_DIM}) c ON o.client_id = c.client_id
LEFT JOIN nation mn ON c.manu_id = mn.n_nationkey
LEFT JOIN ({LOOKUP}) lk ON c.manu_id = lk.manu_id"""

PART_R = "(SELECT p_partkey, p_type FROM part)"
GEO = "(SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"
LINES = f"""
SELECT l.l_orderkey AS report_id, l.l_linenumber, l.l_returnflag, l.l_linestatus, l.l_partkey, l.l_suppkey,
       p.p_partkey, p.p_type, g.r_name AS insp_region
FROM lineitem l
LEFT JOIN {PART_R} p ON ({B.PART_KEY_SQL}) = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN {GEO} g ON s.s_nationkey = g.n_nationkey"""
ENC = (f"SELECT *, " + ", ".join(f"{B.case_sql(v)} AS {k}_result" for k, v in B.RESULTS.items())
       + f", {B.PHASE_SQL} AS phase, {B.TECH_SQL} AS technology FROM ({LINES}) x")
SVC_BUCKET = ("CASE " + " ".join(f"WHEN {{c}} IN ({', '.join(lit(m) for m in ms)}) THEN {lit(lab)}"
                                  for lab, ms in B.SERVICE_BUCKETS.items()) + " ELSE {c} END")


def svc(c: str) -> str:
    return SVC_BUCKET.replace("{c}", c)


def n2p(c: str) -> str:
    return f"CASE WHEN {c} = 'None' THEN 'pass' ELSE {c} END"


def cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def indicator_sql(value_expr: str, domain, prefix: str, agg: str = "max", src: str = ENC) -> str:
    cast = "INTEGER" if agg == "max" else "BIGINT"
    cols = ", ".join(f"CAST({agg}(CASE WHEN v = {lit(d)} THEN 1 ELSE 0 END) AS {cast}) AS {prefix}{B._slug(d)}"
                     for d in domain)
    return f"SELECT report_id, {cols} FROM (SELECT report_id, {value_expr} AS v FROM ({src}) e) z GROUP BY report_id"


def severity_sql(name: str, result: str, where: str | None) -> str:
    w = f"WHERE {where}" if where else ""
    mm = lit(B.LIST_MAJ_MIN)
    return f"""
SELECT report_id,
  CAST(maj + mm AS DOUBLE) / CASE WHEN d = 0 THEN 1 ELSE d END AS {name}_maj,
  CAST(mi + mm AS DOUBLE) / CASE WHEN d = 0 THEN 1 ELSE d END AS {name}_min,
  CAST(pa AS DOUBLE) / CASE WHEN d = 0 THEN 1 ELSE d END AS {name}_pass
FROM (SELECT report_id, mm, maj, mi, pa, 2 * mm + maj + mi + pa AS d FROM (
  SELECT report_id, {cnt(f"r = {mm}")} AS mm, {cnt("r = 'Major'")} AS maj, {cnt("r = 'Minor'")} AS mi,
         {cnt("r = 'pass'")} AS pa
  FROM (SELECT report_id, {n2p(result)} AS r FROM ({ENC}) e {w}) s GROUP BY report_id) c) z"""


def plain_share_sql(result: str, domain_cols: dict[str, str]) -> str:
    counts = ", ".join(f"{cnt(f'{result} = {lit(v)}')} AS {c}_n" for v, c in domain_cols.items())
    d = " + ".join(f"{c}_n" for c in domain_cols.values())
    shares = ", ".join(f"CAST({c}_n AS DOUBLE) / CASE WHEN ({d}) = 0 THEN 1 ELSE ({d}) END AS {c}"
                       for c in domain_cols.values())
    return f"SELECT report_id, {shares} FROM (SELECT report_id, {counts} FROM ({ENC}) e GROUP BY report_id) c"


FEATURES = {
    "qa": indicator_sql(svc("p_type"), B.SERVICE_DOMAIN, "qa_"),
    "celltech": indicator_sql("technology", B.TECH_DOMAIN, "celltech_"),
    "ins": indicator_sql("insp_region", B.REGION_DOMAIN, "ins_", agg="sum"),
    "el": severity_sql("el", "el_result", None),
    "vi1": severity_sql("vi1", "vi_result", "phase = 1"),
    "vi2": severity_sql("vi2", "vi_result", "phase = 2"),
    "cons": plain_share_sql("cons_result", {"Approved": "cons_approve", "Not applicable": "cons_na"}),
    "pt": plain_share_sql("pt_result", {"Conformed": "pt_conformed", "Not conformed": "pt_not_conformed",
                                        "Not applicable": "pt_na", "Partly conformed": "pt_half_conformed"}),
    "label": plain_share_sql("label_result", {"Conformed": "label_conformed",
                                              "Not conformed": "label_not_conformed"}),
    "cert1": f"SELECT report_id, count(phase) AS cert1 FROM ({ENC}) e WHERE phase = 1 GROUP BY report_id",
}
SPEC_COLS = {s.name: s.output_columns() for s in B.feature_specs()}
SHARE_COLS = B.TEST_SHARE_COLUMNS
MASTER_COLS = REPORT_COLUMNS + [c for s in B.feature_specs() for c in s.output_columns()]


def _master_sql() -> str:
    joins, sel = [], []
    for name, sql in FEATURES.items():
        joins.append(f"LEFT JOIN ({sql}) f_{name} ON r.report_id = f_{name}.report_id")
        for c in SPEC_COLS[name]:
            sel.append(f"coalesce(f_{name}.{c}, 0) AS {c}" if name == "cert1" else f"f_{name}.{c}")
    target = rules_sql("r.final_result", TARGET_RULES, TARGET_DEFAULT)
    head = (f"r.report_id, r.report_date, r.product_name, r.manu_add, {target} AS final_result, "
            f"r.manu_std_name, r.client_std_name")
    return f"SELECT {head}, {', '.join(sel)} FROM ({REPORT_BASE}) r " + " ".join(joins)


MASTER = _master_sql()
MASTER_R = rnd(MASTER, SHARE_COLS)


def null_profile_sql(src: str, cols: list[str]) -> str:
    agg = ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in cols)
    return (f"SELECT column_name, miss_num, CAST(miss_num AS DOUBLE) / CAST(n AS DOUBLE) AS miss_rate FROM "
            f"(UNPIVOT (SELECT count(*) AS n, {agg} FROM ({src}) m) ON {', '.join(cols)} "
            f"INTO NAME column_name VALUE miss_num) u")


NULL_PROFILE = null_profile_sql(MASTER, MASTER_COLS)
LABELLED_PROFILE = null_profile_sql(f"SELECT * FROM ({MASTER}) m WHERE final_result IS NOT NULL", MASTER_COLS)

# -------------------------------------------------------------------------- keys
SQL["master"] = MASTER_R
SQL["src_table_scan"] = "SELECT * FROM orders"
SQL["src_columnar_json"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
SQL["src_catalog"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in B.TABLES)
SQL["src_lookup_file"] = SHEET
SQL["src_stage_table"] = MASTER_R
SQL["snk_table"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

LI = "SELECT l_orderkey AS report_id, l_linenumber AS line, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem"
PB = f"SELECT l.*, p.p_partkey, p.p_type FROM ({LI}) l LEFT JOIN {PART_R} p ON ({B.PART_KEY_SQL}) = p.p_partkey"
SQL["brg_qa"] = f"SELECT report_id, line, l_partkey AS service_id, p_type AS service FROM ({PB}) b"


def result_bridge(kind: str, id_name: str, phase: bool = False) -> str:
    ph = f", {B.PHASE_SQL} AS phase" if phase else ""
    return f"SELECT report_id, line, l_partkey AS {id_name}, {B.case_sql(B.RESULTS[kind])} AS result{ph} FROM ({PB}) b"


SQL["brg_performed_test"] = result_bridge("pt", "test_id")
SQL["brg_cons_conf"] = result_bridge("cons", "pcc_id")
SQL["brg_visual"] = result_bridge("vi", "vi_id", True)
SQL["brg_el"] = result_bridge("el", "el_id")
SQL["brg_label"] = result_bridge("label", "lf_check_id")
SQL["brg_cert"] = (f"SELECT l.report_id, l.line, l.l_suppkey AS cert_id, s.s_name AS certificate, "
                   f"{B.PHASE_SQL} AS phase FROM ({LI}) l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey")
INSP_DIM = f"SELECT s.s_suppkey, g.r_name FROM supplier s LEFT JOIN {GEO} g ON s.s_nationkey = g.n_nationkey"
SQL["brg_inspector"] = (f"SELECT l.report_id, l.line, l.l_suppkey AS inspector_id, d.r_name AS inspector "
                        f"FROM ({LI}) l LEFT JOIN ({INSP_DIM}) d ON l.l_suppkey = d.s_suppkey")

SQL["prj_rename"] = ORDERS_VIEW
SQL["prj_drop"] = f"SELECT * EXCLUDE (report_id, product_name) FROM ({MASTER_R}) m"
SQL["prj_without_group"] = f"SELECT * EXCLUDE ({', '.join(SHARE_COLS)}) FROM ({MASTER_R}) m"
SQL["prj_split_xy"] = (f"SELECT * EXCLUDE (final_result), CASE WHEN final_result = 'pass' THEN 1 ELSE 0 END AS label "
                       f"FROM ({MASTER_R}) m WHERE final_result IS NOT NULL")
SQL["prj_constant"] = "SELECT o_orderkey AS report_id, 0 AS cert2 FROM orders"
SQL["flt_phase"] = f"SELECT * FROM ({SQL['brg_visual']}) v WHERE phase = 1"
SQL["flt_drop_null_target"] = f"SELECT * FROM ({MASTER_R}) m WHERE final_result IS NOT NULL"
SQL["flt_exclude_none"] = (f"SELECT DISTINCT result AS value FROM ({SQL['brg_cons_conf']}) c "
                           f"WHERE result IS NOT NULL AND result <> 'None'")
SQL["flt_missing_only"] = rnd(f"SELECT column_name, miss_rate FROM ({LABELLED_PROFILE}) p WHERE miss_rate > 0",
                              ["miss_rate"])
SQL["upd_conditional_by_key"] = (
    "SELECT o.o_orderkey AS report_id, coalesce(c.n, 0) AS cert1 FROM orders o LEFT JOIN "
    "(SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey) c "
    "ON o.o_orderkey = c.l_orderkey")

SQL["jn_dim_manufacturer"] = (
    f"SELECT o.o_orderkey AS report_id, nullif(c.c_nationkey, {B.NULL_MANUFACTURER}) AS manu_id, "
    f"n.n_name AS manu_std_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
    f"LEFT JOIN nation n ON nullif(c.c_nationkey, {B.NULL_MANUFACTURER}) = n.n_nationkey")
SQL["jn_dim_client"] = ("SELECT o.o_orderkey AS report_id, c.c_mktsegment AS client_std_name FROM orders o "
                        "LEFT JOIN customer c ON o.o_custkey = c.c_custkey")
SQL["jn_country_lookup"] = f"SELECT report_id, manu_id, manu_add FROM ({REPORT_BASE}) r"
SQL["chk_unmatched_keys"] = (
    f"SELECT manu_id, count(*) AS n_rows FROM ({REPORT_BASE}) r WHERE manu_id IS NOT NULL AND manu_id NOT IN "
    f"(SELECT manu_id FROM ({LOOKUP}) k WHERE country <> 'MIDDLE EAST') GROUP BY manu_id")


def feature_join(name: str) -> str:
    cols = SPEC_COLS[name]
    sel = ", ".join(f"coalesce(f.{c}, 0) AS {c}" if name == "cert1" else f"f.{c}" for c in cols)
    shares = [c for c in cols if c in SHARE_COLS]
    return rnd(f"SELECT o.o_orderkey AS report_id, {sel} FROM orders o LEFT JOIN ({FEATURES[name]}) f "
               f"ON o.o_orderkey = f.report_id", shares)


for _n in ("qa", "celltech", "el", "vi1", "vi2", "cons", "pt", "label"):
    SQL[f"jn_feature_{_n}"] = feature_join(_n)
SQL["jn_feature_inspector"] = feature_join("ins")
SQL["jn_feature_cert"] = feature_join("cert1")

AQL_EXPR = ["l_quantity", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)", "l_extendedprice / 997",
            "1 - l_discount"]
AQL_COLS = ["crit_acc", "crit_rej", "maj_acc", "maj_rej", "min_acc", "min_rej"]
AQL_MEANS = ("SELECT l_orderkey AS report_id, " + ", ".join(f"avg({e}) AS {c}" for e, c in zip(AQL_EXPR, AQL_COLS))
             + " FROM lineitem GROUP BY l_orderkey")
AQL_SCORE = ("SELECT report_id, 3.0 * (crit_acc - crit_rej) + 2.0 * (maj_acc - maj_rej) + 1.0 * (min_acc - min_rej) "
             f"AS aql_score FROM ({AQL_MEANS}) a")
SQL["jn_feature_aql"] = rnd(f"SELECT o.o_orderkey AS report_id, CAST(a.aql_score AS DOUBLE) AS aql_score FROM orders o "
                            f"LEFT JOIN ({AQL_SCORE}) a ON o.o_orderkey = a.report_id", ["aql_score"])

EL_BRIDGE = SQL["brg_el"]
SQL["agg_count_pivot"] = (
    f"SELECT report_id, {cnt('r = ' + lit(B.LIST_MAJ_MIN))} AS n_maj_min, {cnt(chr(114) + ' = ' + lit('Major'))} AS n_major, "
    f"{cnt('r = ' + lit('Minor'))} AS n_minor, {cnt('r = ' + lit('pass'))} AS n_pass "
    f"FROM (SELECT report_id, {n2p('result')} AS r FROM ({EL_BRIDGE}) b) s GROUP BY report_id")
SQL["agg_indicator_max"] = indicator_sql(svc("service"), B.SERVICE_DOMAIN, "qa_", src=SQL["brg_qa"])
SQL["agg_indicator_drop_blank"] = indicator_sql(B.TECH_SQL, B.TECH_DOMAIN, "celltech_", src=PB)
SQL["agg_indicator_sum"] = indicator_sql("inspector", B.REGION_DOMAIN, "ins_", agg="sum", src=SQL["brg_inspector"])
SQL["agg_group_count"] = (f"SELECT report_id, count(phase) AS cert1 FROM ({SQL['brg_cert']}) c "
                          f"WHERE phase = 1 GROUP BY report_id")
SQL["agg_group_mean"] = rnd(AQL_MEANS, AQL_COLS)
SQL["agg_aql_score"] = rnd(f"SELECT report_id, CAST(aql_score AS DOUBLE) AS aql_score FROM ({AQL_SCORE}) s", ["aql_score"])
SQL["agg_distinct"] = "SELECT DISTINCT l_orderkey AS report_id FROM lineitem"
SQL["agg_domain"] = (f"SELECT DISTINCT v AS value FROM (SELECT {svc('service')} AS v FROM ({SQL['brg_qa']}) b) s "
                     f"WHERE v IS NOT NULL AND v <> 'None'")
SQL["agg_collect_list"] = (
    f"SELECT report_id, string_agg(coalesce(inspector, 'null') || ':' || CAST(n AS VARCHAR), ',' ORDER BY inspector, n) "
    f"AS inspectors FROM (SELECT report_id, inspector, count(*) AS n FROM ({SQL['brg_inspector']}) b "
    f"GROUP BY report_id, inspector) c GROUP BY report_id")
SQL["agg_null_count"] = f"SELECT column_name, miss_num FROM ({NULL_PROFILE}) p"
SQL["agg_null_rate"] = rnd(f"SELECT column_name, miss_rate FROM ({NULL_PROFILE}) p", ["miss_rate"])
SQL["agg_missing_report"] = rnd(f"SELECT * FROM ({LABELLED_PROFILE}) p WHERE miss_rate > 0", ["miss_rate"])
SQL["srt_desc"] = rnd(f"SELECT column_name, miss_rate, CAST(row_number() OVER (ORDER BY miss_rate DESC, column_name) AS INTEGER) AS place "
                      f"FROM ({LABELLED_PROFILE}) p", ["miss_rate"])
_DT = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
       "WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' "
       "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END")
SQL["agg_schema_profile"] = (f"SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, {_DT} AS dtype "
                             f"FROM (DESCRIBE {MASTER}) d")
SQL["agg_class_distribution"] = (f"SELECT final_result, count(*) AS n FROM ({MASTER}) m "
                                 f"WHERE final_result IS NOT NULL GROUP BY final_result")

SCORED = (f"SELECT l.doc_id, d.source, CASE WHEN l.quality = 1 THEN '{E.POS}' ELSE '{E.NEG}' END AS truth, "
          f"CAST(d.n_chars AS DOUBLE) / CAST(d.n_chars + 1000 AS DOUBLE) AS p_pass "
          f"FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
EPS = repr(E.LOG_LOSS_EPS)
PTRUE = (f"CASE WHEN truth = '{E.POS}' THEN least(greatest(p_pass, {EPS}), 1 - {EPS}) "
         f"ELSE 1 - least(greatest(p_pass, {EPS}), 1 - {EPS}) END")


def cells_sql(pred: str, group: str | None = None, extra: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return (f"SELECT {g}{cnt(f'truth = {lit(E.NEG)} AND {pred} = {lit(E.NEG)}')} AS c00, "
            f"{cnt(f'truth = {lit(E.NEG)} AND {pred} = {lit(E.POS)}')} AS c01, "
            f"{cnt(f'truth = {lit(E.POS)} AND {pred} = {lit(E.NEG)}')} AS c10, "
            f"{cnt(f'truth = {lit(E.POS)} AND {pred} = {lit(E.POS)}')} AS c11{extra} FROM ({SCORED}) s{gb}")


PAIR = ("CAST(c00 + c11 AS DOUBLE) / CAST(c00 + c01 + c10 + c11 AS DOUBLE) AS accuracy, "
        "CASE WHEN c00 + c10 > 0 THEN CAST(c00 AS DOUBLE) / CAST(c00 + c10 AS DOUBLE) ELSE 1.0 END AS npass_precision, "
        "CASE WHEN c01 + c11 > 0 THEN CAST(c11 AS DOUBLE) / CAST(c01 + c11 AS DOUBLE) ELSE 1.0 END AS pass_precision")
PRED05 = f"(CASE WHEN p_pass > 0.5 THEN '{E.POS}' ELSE '{E.NEG}' END)"
SQL["ml_predict_threshold"] = rnd(f"SELECT doc_id, truth, p_pass, {PRED05} AS prediction FROM ({SCORED}) s", ["p_pass"])
SQL["ml_confusion"] = (f"SELECT * FROM (SELECT c00, c01, c10, c11 FROM ({cells_sql(PRED05)}) c) x "
                       f"CROSS JOIN LATERAL (VALUES ('{E.NEG}', '{E.NEG}', c00), ('{E.NEG}', '{E.POS}', c01), "
                       f"('{E.POS}', '{E.NEG}', c10), ('{E.POS}', '{E.POS}', c11)) v(truth, predicted, n)")
SQL["ml_confusion"] = f"SELECT truth, predicted, n FROM ({SQL['ml_confusion']}) y"
SQL["ml_precision_pair"] = rnd(f"SELECT {PAIR} FROM ({cells_sql(PRED05)}) c",
                               ["accuracy", "npass_precision", "pass_precision"])
SQL["ml_log_loss"] = rnd(f"SELECT -avg(ln({PTRUE})) AS log_loss, count(*) AS n FROM ({SCORED}) s", ["log_loss"])
_REP = f"""
WITH c AS (SELECT c00, c01, c10, c11 FROM ({cells_sql(PRED05)}) x),
k AS (
  SELECT '{E.NEG}' AS label, c00 AS tp, c00 + c10 AS pp, c00 + c01 AS sup FROM c
  UNION ALL SELECT '{E.POS}', c11, c01 + c11, c10 + c11 FROM c),
m AS (SELECT label, CASE WHEN pp > 0 THEN CAST(tp AS DOUBLE) / pp ELSE 0.0 END AS precision,
             CASE WHEN sup > 0 THEN CAST(tp AS DOUBLE) / sup ELSE 0.0 END AS recall, sup FROM k),
f AS (SELECT label, precision, recall,
             CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
             CAST(sup AS BIGINT) AS support FROM m),
t AS (SELECT CAST(c00 + c01 + c10 + c11 AS BIGINT) AS n, CAST(c00 + c11 AS DOUBLE) / (c00 + c01 + c10 + c11) AS acc FROM c)
SELECT label, precision, recall, f1, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM t
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), (SELECT n FROM t) FROM f
UNION ALL SELECT 'weighted avg', sum(precision * support) / (SELECT n FROM t), sum(recall * support) / (SELECT n FROM t),
                 sum(f1 * support) / (SELECT n FROM t), (SELECT n FROM t) FROM f"""
SQL["ml_classification_report"] = rnd(_REP, ["precision", "recall", "f1"])
_TS = ", ".join(f"(CAST({t} AS DOUBLE))" for t in E.SWEEP_THRESHOLDS)
SQL["ml_threshold_sweep"] = rnd(f"""
SELECT threshold, c01 + c11 AS n_pred_pass, {PAIR} FROM (
  SELECT t.threshold,
    {cnt(f"s.truth = '{E.NEG}' AND NOT (s.p_pass > t.threshold)")} AS c00,
    {cnt(f"s.truth = '{E.NEG}' AND s.p_pass > t.threshold")} AS c01,
    {cnt(f"s.truth = '{E.POS}' AND NOT (s.p_pass > t.threshold)")} AS c10,
    {cnt(f"s.truth = '{E.POS}' AND s.p_pass > t.threshold")} AS c11
  FROM ({SCORED}) s, (VALUES {_TS}) t(threshold) GROUP BY t.threshold) c""",
                                ["threshold", "accuracy", "npass_precision", "pass_precision"])
RUN_METRICS = (f"SELECT source, {PAIR}, log_loss FROM ({cells_sql(PRED05, 'source', f', -avg(ln({PTRUE})) AS log_loss')}) c")
SQL["agg_run_stats"] = rnd(" UNION ALL ".join(
    f"SELECT '{m}' AS metric, avg({m}) AS mean, stddev_samp({m}) AS sd, count(*) AS runs FROM ({RUN_METRICS}) r"
    for m in E.RUN_METRICS), ["mean", "sd"])
def histogram_sql(metric: str) -> str:
    return f"""
WITH r AS (SELECT {metric} AS accuracy FROM ({RUN_METRICS}) z),
mm AS (SELECT CASE WHEN min(accuracy) = max(accuracy) THEN min(accuracy) - 0.5 ELSE min(accuracy) END AS lo,
              CASE WHEN min(accuracy) = max(accuracy) THEN max(accuracy) + 0.5 ELSE max(accuracy) END AS hi FROM r),
b AS (SELECT CAST(least(floor((accuracy - mm.lo) * (50 / (mm.hi - mm.lo))), 49) AS INTEGER) AS bin FROM r, mm),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
e AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT '{metric}' AS metric, e.bin, mm.lo + e.bin * ((mm.hi - mm.lo) / 50) AS lo, mm.lo + (e.bin + 1) * ((mm.hi - mm.lo) / 50) AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM e CROSS JOIN mm LEFT JOIN c ON e.bin = c.bin"""


SQL["agg_histogram"] = rnd(" UNION ALL ".join(f"(SELECT * FROM ({histogram_sql(m)}) h)" for m in ("accuracy", "npass_precision", "pass_precision")),
                           ["lo", "hi"])

for _n in ("el", "vi1", "vi2", "cons", "pt", "label"):
    SQL[f"rat_{_n}"] = rnd(FEATURES[_n], SPEC_COLS[_n])
SQL["rat_exploded"] = SQL["rat_el"]

SQL["fn_map_values"] = f"SELECT report_id, line, {svc('service')} AS service FROM ({SQL['brg_qa']}) b"
SQL["fn_none_to_pass"] = f"SELECT report_id, line, {n2p('result')} AS result FROM ({EL_BRIDGE}) b"
SQL["fn_rule_classify"] = (f"SELECT report_id, final_result AS raw_result, "
                           f"{rules_sql('final_result', TARGET_RULES, TARGET_DEFAULT)} AS final_result "
                           f"FROM ({ORDERS_VIEW}) o")
SQL["fn_keyword_country"] = f"SELECT doc_id, {rules_sql('text', COUNTRY_RULES, None)} AS country FROM documents"
_WL = ", ".join(lit(str(i)) for i in [8, 5, 12, 15, 17, 1, 11])
SQL["fn_whitelist_other"] = (f"SELECT report_id, line, CASE WHEN inspector_id IS NULL THEN NULL "
                             f"WHEN CAST(inspector_id AS VARCHAR) IN ({_WL}) THEN CAST(inspector_id AS VARCHAR) "
                             f"ELSE 'other' END AS inspector FROM ({SQL['brg_inspector']}) b")
SQL["fn_lower"] = f"SELECT report_id, lower(final_result) AS lower_result FROM ({ORDERS_VIEW}) o"
SQL["fn_contains"] = (f"SELECT report_id, contains(lower(final_result), 'not') AS has_not, "
                      f"contains(lower(final_result), 'pass') AS has_pass FROM ({ORDERS_VIEW}) o")
SQL["fn_is_nan"] = (f"SELECT o.o_orderkey AS report_id, nullif(c.c_nationkey, {B.NULL_MANUFACTURER}) IS NULL "
                    f"AS manu_id_missing FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey")
SQL["fn_zero_guard"] = (f"SELECT report_id, d AS denominator, CASE WHEN d = 0 THEN 1 ELSE d END AS guarded FROM "
                        f"(SELECT report_id, n_maj_min * 2 + n_major + n_minor + n_pass AS d "
                        f"FROM ({SQL['agg_count_pivot']}) c) z")
SQL["lim_first"] = LOOKUP

# -------------------------------------------------------------------------- 2.8 preparation / ADASYN
CAT_DOMAINS = {
    "product_name": ["F", "O", "P"],
    "manu_add": sorted(B.REGION_DOMAIN + [f"NATION_{B.NULL_MANUFACTURER}"]),
    "manu_std_name": sorted(f"NATION_{i}" for i in range(25) if i != B.NULL_MANUFACTURER),
    "client_std_name": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}


def _slug(v) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(v).lower()).strip("_")


SQL["ml_dummies"] = "SELECT report_id, " + ", ".join(
    f"CASE WHEN {c} = {lit(v)} THEN 1 ELSE 0 END AS {c}_{_slug(v)}"
    for c, dom in CAT_DOMAINS.items() for v in dom) + f" FROM ({MASTER}) m"
SQL["ml_label_encode"] = "SELECT report_id, " + ", ".join(
    f"CAST(CASE WHEN {c} IS NULL THEN (SELECT count(DISTINCT {c}) FROM ({MASTER}) z) "
    f"ELSE dense_rank() OVER (ORDER BY {c}) - 1 END AS DOUBLE) AS {c}_code"
    for c in CAT_DOMAINS) + f" FROM ({MASTER}) m"
_LM = f"SELECT * FROM ({MASTER}) m WHERE final_result IS NOT NULL"
_NUM = [c for c in MASTER_COLS if c not in ("report_id", "report_date", "final_result") and c not in CAT_DOMAINS]
SQL["ml_impute_init"] = rnd(
    "SELECT report_id, report_date, final_result, " + ", ".join(
        f"CAST(coalesce(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM lm)) AS DOUBLE) AS {c}" for c in _NUM)
    + ", " + ", ".join(
        f"coalesce({c}, (SELECT {c} FROM lm WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
        for c in CAT_DOMAINS) + " FROM lm",
    _NUM)
SQL["ml_impute_init"] = f"WITH lm AS ({_LM}) " + SQL["ml_impute_init"]
SQL["ml_split_stratified"] = f"""
WITH m AS ({_LM}),
c AS (SELECT final_result, count(*) AS n FROM m GROUP BY final_result),
t AS (SELECT sum(n) AS total, CAST(ceil(CAST(0.1 AS DOUBLE) * sum(n)) AS BIGINT) AS nt FROM c),
a AS (SELECT final_result, floor(nt * n / total) AS base, nt * n / total - floor(nt * n / total) AS frac FROM c, t),
r AS (SELECT final_result, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, final_result)
                                     <= (SELECT nt FROM t) - (SELECT sum(base) FROM a) THEN 1 ELSE 0 END AS k FROM a),
x AS (SELECT report_id, final_result,
             row_number() OVER (PARTITION BY final_result ORDER BY {hash_u32_sql_('report_id', 42, 'split')}, report_id) AS rn
      FROM m)
SELECT x.report_id, x.final_result, x.rn <= r.k AS is_test FROM x JOIN r ON x.final_result = r.final_result"""

EMB_DIMS = 64
_EMB = "SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(1, EMB_DIMS + 1)) + \
       " FROM embeddings"
_D2 = " + ".join(f"(q.e{i} - p.e{i}) * (q.e{i} - p.e{i})" for i in range(1, EMB_DIMS + 1))
_HARD = f"""
WITH pt AS ({_EMB}), q AS (SELECT * FROM pt WHERE label < 3),
nn AS (SELECT q.vec_id AS qid, p.label AS plabel,
              row_number() OVER (PARTITION BY q.vec_id ORDER BY {_D2}, p.vec_id) AS rk
       FROM q JOIN pt p ON q.vec_id <> p.vec_id),
h AS (SELECT q.vec_id AS qid, CAST(coalesce(sum(CASE WHEN nn.plabel >= 3 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_major
      FROM q LEFT JOIN nn ON q.vec_id = nn.qid AND nn.rk <= 5 GROUP BY q.vec_id),
s AS (SELECT sum(n_major) AS tot FROM h),
g AS (SELECT sum(CASE WHEN label >= 3 THEN 1 ELSE 0 END) - sum(CASE WHEN label < 3 THEN 1 ELSE 0 END) AS g FROM pt),
r AS (SELECT qid, n_major, n_major * g.g AS num, s.tot AS den FROM h, s, g)
SELECT qid AS vec_id, n_major, CAST(n_major AS DOUBLE) / 5.0 AS hardness,
       CAST(floor(num / den) + CASE WHEN 2 * (num - floor(num / den) * den) > den
                                    OR (2 * (num - floor(num / den) * den) = den AND floor(num / den) % 2 = 1)
                               THEN 1 ELSE 0 END AS INTEGER) AS n_generate
FROM r"""
SQL["ml_adasyn_hardness"] = rnd(_HARD, ["hardness"])
_S1 = 11
_SAMPLES = f"""
WITH mn AS (SELECT * FROM ({_EMB}) e WHERE label < 3),
nn AS (SELECT q.vec_id AS qid, p.vec_id AS pid,
              row_number() OVER (PARTITION BY q.vec_id ORDER BY {_D2}, p.vec_id) AS rk
       FROM mn q JOIN mn p ON q.vec_id <> p.vec_id),
g AS ({_HARD}),
s AS (SELECT vec_id AS qid, CAST(unnest(range(1, n_generate + 1)) AS BIGINT) AS j FROM g WHERE n_generate > 0),
pick AS (SELECT qid, j,
   CAST(floor({hash_unit_sql(['qid', 'j'], _S1, 'adasyn-neighbour')} * 5) AS INTEGER) + 1 AS rk,
   {hash_unit_sql(['qid', 'j'], _S1, 'adasyn-u')} AS u FROM s)
SELECT pick.qid AS vec_id, pick.j, """ + ", ".join(f"q.e{i} + pick.u * (p.e{i} - q.e{i}) AS e{i}" for i in range(1, EMB_DIMS + 1)) + """
FROM pick JOIN nn ON pick.qid = nn.qid AND pick.rk = nn.rk
JOIN mn q ON q.vec_id = pick.qid JOIN mn p ON p.vec_id = nn.pid"""
SQL["ml_adasyn_samples"] = rnd(_SAMPLES, [f"e{i}" for i in range(1, EMB_DIMS + 1)])
