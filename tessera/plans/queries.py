"""Registered queries: one per operator key of the inventory, bound to the
driver tables.  Each takes (spark, sf_dir) and returns a DataFrame; model queries
run the fits that they need while they are built.

Doubles are rounded to 6 digits at the very end of each query so results
compare across engines; the operators themselves never round.
"""
from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalars as S
from tessera.ml import evaluate as E
from tessera.operators import joins as J
from tessera.operators import pivots as P
from tessera.operators import profile as PR
from tessera.operators.bridge import bridge_join
from tessera.operators.shares import exploded_shares
from tessera.operators.update import update_by_key
from tessera.plans import binding as B
from tessera.plans.features import aggregate_source, attach_specs
from tessera.plans.master import build_master, feature_sources, report_base
from tessera.session import checkpoint, session_store, shared_path
from tessera.sources import columnar_json as CJ
from tessera.sources.lookup import read_lookup_csv
from tessera.sources.stage import read_stage_table, write_table
from tessera.sources.tables import read_table, read_tables, register_catalog

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _t(spark, sf) -> B.Tables:
    return B.Tables(spark, sf)


def _spec(name: str):
    return next(s for s in B.feature_specs() if s.name == name)


def _lines(t: B.Tables, with_supplier: bool = False) -> DataFrame:
    return B.with_results(B.line_bridge(t, with_supplier=with_supplier))


# ---------------------------------------------------------------- flagship
@query("master")
def q_master(spark, sf):
    return rounded(build_master(_t(spark, sf)))


# ---------------------------------------------------------------- 2.1 sources / sinks
@query("src_table_scan")
def q_src_table_scan(spark, sf):
    return read_table(spark, sf, "orders")


@query("src_columnar_json")
def q_src_columnar_json(spark, sf):
    cust = read_table(spark, sf, "customer")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    path = shared_path(spark, "columnar-json")
    CJ.write_columnar_json(cust, path, cols)
    back = CJ.read_columnar_json(spark, path, [str(i) for i in range(len(cols))], cols,
                                 [T.LongType(), T.StringType(), T.IntegerType(), T.DoubleType(), T.StringType()])
    return back.select(*cols)


@query("src_catalog")
def q_src_catalog(spark, sf):
    tables = read_tables(spark, sf, B.TABLES)
    views = register_catalog(tables, prefix="tessera_")
    parts = [spark.table(v).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, v in views.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("src_lookup_file")
def q_src_lookup_file(spark, sf):
    t = _t(spark, sf)
    path = shared_path(spark, "lookup-csv")
    write_table(B.address_lookup(t).select(F.col("_order").alias("line"), "manu_id", "country"), path, fmt="csv")
    sheet = read_lookup_csv(spark, path, "line long, manu_id int, country string", order="line")
    return sheet.select("manu_id", "country", "_order")


@query("src_stage_table")
def q_src_stage_table(spark, sf):
    path = shared_path(spark, "stage-master")
    write_table(build_master(_t(spark, sf)), path)
    return rounded(read_stage_table(spark, path))


@query("snk_table")
def q_snk_table(spark, sf):
    path = shared_path(spark, "sink-csv")
    write_table(read_table(spark, sf, "customer"), path, fmt="csv")
    return spark.read.csv(path, header=True,
                          schema="c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


# ---------------------------------------------------------------- 2.2 bridge joins
def _li(t: B.Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("report_id"), "l_partkey", "l_suppkey", "l_linenumber",
                             "l_returnflag", "l_linestatus")


def _phases(t: B.Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("report_id"), F.expr(B.PHASE_SQL).alias("phase"))


def _part_bridge(t: B.Tables) -> DataFrame:
    keyed = _li(t).withColumn("part_key", F.expr(B.PART_KEY_SQL))
    return bridge_join(keyed, t.part.select("p_partkey", "p_type"), "part_key", "p_partkey", keep=["p_partkey", "p_type"])


def _result_bridge(spark, sf, kind: str, id_name: str, with_phase: bool = False) -> DataFrame:
    b = _part_bridge(_t(spark, sf))
    cols = [F.col("report_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias(id_name),
            B.case_column(B.RESULTS[kind]).alias("result")]
    if with_phase:
        cols.append(F.expr(B.PHASE_SQL).alias("phase"))
    return b.select(*cols)


@query("brg_qa")
def q_brg_qa(spark, sf):
    b = _part_bridge(_t(spark, sf))
    return b.select("report_id", F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("service_id"),
                    F.col("p_type").alias("service"))


@query("brg_performed_test")
def q_brg_pt(spark, sf):
    return _result_bridge(spark, sf, "pt", "test_id")


@query("brg_cons_conf")
def q_brg_cons(spark, sf):
    return _result_bridge(spark, sf, "cons", "pcc_id")


@query("brg_visual")
def q_brg_visual(spark, sf):
    return _result_bridge(spark, sf, "vi", "vi_id", with_phase=True)


@query("brg_el")
def q_brg_el(spark, sf):
    return _result_bridge(spark, sf, "el", "el_id")


@query("brg_label")
def q_brg_label(spark, sf):
    return _result_bridge(spark, sf, "label", "lf_check_id")


@query("brg_cert")
def q_brg_cert(spark, sf):
    t = _t(spark, sf)
    sup = t.supplier.select("s_suppkey", "s_name")
    b = bridge_join(_li(t), sup, "l_suppkey", "s_suppkey", keep=["s_name"])
    return b.select("report_id", F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("cert_id"),
                    F.col("s_name").alias("certificate"), F.expr(B.PHASE_SQL).alias("phase"))


def _inspector_dim(t: B.Tables) -> DataFrame:
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    return s.join(geo, s["s_nationkey"] == geo["n_nationkey"], "left").select("s_suppkey", "r_name")


@query("brg_inspector")
def q_brg_inspector(spark, sf):
    t = _t(spark, sf)
    b = bridge_join(_li(t), _inspector_dim(t), "l_suppkey", "s_suppkey", keep=["r_name"])
    return b.select("report_id", F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("inspector_id"),
                    F.col("r_name").alias("inspector"))


# ---------------------------------------------------------------- 2.3 projections / filters
@query("prj_rename")
def q_prj_rename(spark, sf):
    return B.orders_view(_t(spark, sf))


@query("prj_drop")
def q_prj_drop(spark, sf):
    return rounded(build_master(_t(spark, sf)).drop("report_id", "product_name"))


@query("prj_without_group")
def q_prj_without_group(spark, sf):
    return rounded(build_master(_t(spark, sf)).drop(*B.TEST_SHARE_COLUMNS))


@query("prj_split_xy")
def q_prj_split_xy(spark, sf):
    """Features (every column but the target) and the 0/1 label."""
    m = build_master(_t(spark, sf)).where(F.col(B.TARGET).isNotNull())
    return rounded(m.withColumn("label", F.when(F.col(B.TARGET) == E.POS, 1).otherwise(0)).drop(B.TARGET))


@query("prj_constant")
def q_prj_constant(spark, sf):
    return B.orders_view(_t(spark, sf)).select("report_id", F.lit(0).alias("cert2"))


@query("flt_phase")
def q_flt_phase(spark, sf):
    return q_brg_visual(spark, sf).where(F.col("phase") == 1)


@query("flt_drop_null_target")
def q_flt_drop_null_target(spark, sf):
    return rounded(build_master(_t(spark, sf)).dropna(subset=[B.TARGET]))


@query("flt_exclude_none")
def q_flt_exclude_none(spark, sf):
    return P.domain_frame(q_brg_cons(spark, sf), "result", exclude=("None",))


@query("flt_missing_only")
def q_flt_missing_only(spark, sf):
    rep = PR.missing_report(_labelled_master(spark, sf))
    return rounded(rep.select("column_name", "miss_rate"))


@query("upd_conditional_by_key")
def q_upd_conditional_by_key(spark, sf):
    t = _t(spark, sf)
    base = B.orders_view(t).select("report_id", F.lit(0).cast("long").alias("cert1"))
    counts = P.group_count(_phases(t), "report_id", "phase", "cert1", where=F.col("phase") == 1)
    return update_by_key(base, counts, "report_id", "cert1")


# ---------------------------------------------------------------- 2.4 joins
@query("jn_dim_manufacturer")
def q_jn_dim_manufacturer(spark, sf):
    t = _t(spark, sf)
    rep = J.dim_join(B.orders_view(t), B.client_dim(t), "client_id", "client_id", ["manu_id"])
    out = J.dim_join(rep, B.manufacturer_dim(t), "manu_id", "manu_id", ["manu_std_name"])
    return out.select("report_id", "manu_id", "manu_std_name")


@query("jn_dim_client")
def q_jn_dim_client(spark, sf):
    t = _t(spark, sf)
    cust = t.customer.select(F.col("c_custkey"), F.col("c_mktsegment").alias("client_std_name"))
    out = J.dim_join(B.orders_view(t), cust, "client_id", "c_custkey", ["client_std_name"])
    return out.select("report_id", "client_std_name")


@query("jn_country_lookup")
def q_jn_country_lookup(spark, sf):
    return report_base(_t(spark, sf)).select("report_id", "manu_id", "manu_add")


@query("chk_unmatched_keys")
def q_chk_unmatched_keys(spark, sf):
    t = _t(spark, sf)
    rep = J.dim_join(B.orders_view(t), B.client_dim(t), "client_id", "client_id", ["manu_id"])
    first = J.first_per_key(B.address_lookup(t), "manu_id", "country", "_order")
    partial = first.where(F.col("country") != "MIDDLE EAST")
    return J.unmatched_keys(rep, partial, "manu_id", "manu_id")


def _feature_join(spark, sf, name: str) -> DataFrame:
    t = _t(spark, sf)
    spec = _spec(name)
    rep = B.orders_view(t).select("report_id")
    return rounded(attach_specs(rep, "report_id", feature_sources(t, [spec]), [spec]))


for _name in ("qa", "celltech", "el", "vi1", "vi2", "cons", "pt", "label"):
    REGISTRY[f"jn_feature_{_name}"] = (lambda n: (lambda spark, sf: _feature_join(spark, sf, n)))(_name)
REGISTRY["jn_feature_inspector"] = lambda spark, sf: _feature_join(spark, sf, "ins")
REGISTRY["jn_feature_cert"] = lambda spark, sf: _feature_join(spark, sf, "cert1")

AQL_SQL = ["l_quantity", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)",
           "l_extendedprice / 997", "1 - l_discount"]
AQL_COLS = ["crit_acc", "crit_rej", "maj_acc", "maj_rej", "min_acc", "min_rej"]


def _aql(t: B.Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("report_id"),
                             *[F.expr(e).alias(c) for e, c in zip(AQL_SQL, AQL_COLS)])


@query("jn_feature_aql")
def q_jn_feature_aql(spark, sf):
    t = _t(spark, sf)
    score = P.aql_score(_aql(t), "report_id", *AQL_COLS)
    return rounded(J.attach_features(B.orders_view(t).select("report_id"), score, "report_id"))


# ---------------------------------------------------------------- 2.5 aggregations
@query("agg_count_pivot")
def q_agg_count_pivot(spark, sf):
    b = q_brg_el(spark, sf).withColumn("result", S.none_to_pass("result"))
    names = {B.LIST_MAJ_MIN: "n_maj_min", "Major": "n_major", "Minor": "n_minor", "pass": "n_pass"}
    return P.count_pivot(b, "report_id", "result", B.SEVERITY_DOMAIN, names)


@query("agg_indicator_max")
def q_agg_indicator_max(spark, sf):
    b = q_brg_qa(spark, sf).withColumn("service", S.map_values("service", B.SERVICE_BUCKETS))
    return P.indicator_max(b, "report_id", "service", B.SERVICE_DOMAIN,
                           {v: f"qa_{B._slug(v)}" for v in B.SERVICE_DOMAIN})


@query("agg_indicator_drop_blank")
def q_agg_indicator_drop_blank(spark, sf):
    b = _part_bridge(_t(spark, sf)).withColumn("technology", F.expr(B.TECH_SQL))
    return P.indicator_max(b, "report_id", "technology", B.TECH_DOMAIN,
                           {v: f"celltech_{B._slug(v)}" for v in B.TECH_DOMAIN})


@query("agg_indicator_sum")
def q_agg_indicator_sum(spark, sf):
    b = q_brg_inspector(spark, sf)
    return P.indicator_sum(b, "report_id", "inspector", B.REGION_DOMAIN,
                           {v: f"ins_{B._slug(v)}" for v in B.REGION_DOMAIN})


@query("agg_group_count")
def q_agg_group_count(spark, sf):
    return P.group_count(_phases(_t(spark, sf)), "report_id", "phase", "cert1", where=F.col("phase") == 1)


@query("agg_group_mean")
def q_agg_group_mean(spark, sf):
    return rounded(P.group_mean(_aql(_t(spark, sf)), "report_id", AQL_COLS))


@query("agg_aql_score")
def q_agg_aql_score(spark, sf):
    return rounded(P.aql_score(_aql(_t(spark, sf)), "report_id", *AQL_COLS))


@query("agg_distinct")
def q_agg_distinct(spark, sf):
    return q_brg_qa(spark, sf).select("report_id").distinct()


@query("agg_domain")
def q_agg_domain(spark, sf):
    b = q_brg_qa(spark, sf).withColumn("service", S.map_values("service", B.SERVICE_BUCKETS))
    return P.domain_frame(b, "service")


@query("agg_collect_list")
def q_agg_collect_list(spark, sf):
    vc = P.value_counts(q_brg_inspector(spark, sf), "report_id", "inspector")
    txt = F.array_join(F.transform("inspector_counts",
                                   lambda s: F.concat_ws(":", F.coalesce(s["value"], F.lit("null")),
                                                         s["n"].cast("string"))), ",")
    return vc.select("report_id", txt.alias("inspectors"))


def _master(spark, sf) -> DataFrame:
    return build_master(_t(spark, sf))


@query("agg_null_count")
def q_agg_null_count(spark, sf):
    return PR.null_counts(_master(spark, sf))


@query("agg_null_rate")
def q_agg_null_rate(spark, sf):
    return rounded(PR.null_rates(_master(spark, sf)))


@query("agg_missing_report")
def q_agg_missing_report(spark, sf):
    return rounded(PR.missing_report(_labelled_master(spark, sf)))


@query("agg_schema_profile")
def q_agg_schema_profile(spark, sf):
    return PR.schema_profile(spark, _master(spark, sf))


@query("agg_class_distribution")
def q_agg_class_distribution(spark, sf):
    return PR.class_distribution(_master(spark, sf), B.TARGET)


def _scored(spark, sf) -> DataFrame:
    """labels JOIN documents: truth = quality, P(pass) = n_chars / (n_chars + 1000)."""
    t = _t(spark, sf)
    lab = t.labels.select("doc_id", "quality")
    docs = t.documents.select("doc_id", "source", "n_chars")
    j = lab.join(docs, "doc_id")
    return j.select("doc_id", "source",
                    F.when(F.col("quality") == 1, F.lit(E.POS)).otherwise(F.lit(E.NEG)).alias("truth"),
                    (F.col("n_chars").cast("double") / (F.col("n_chars") + F.lit(1000)).cast("double")).alias("p_pass"))


def _run_metrics(spark, sf) -> DataFrame:
    return E.metrics_by_run(_scored(spark, sf), "source", "truth", "p_pass", 0.5)


@query("agg_run_stats")
def q_agg_run_stats(spark, sf):
    return rounded(E.run_stats(_run_metrics(spark, sf)))


@query("agg_histogram")
def q_agg_histogram(spark, sf):
    runs = _run_metrics(spark, sf)
    out = None
    for metric in ("accuracy", "npass_precision", "pass_precision"):
        one = E.histogram(spark, runs, metric, 50).select(F.lit(metric).alias("metric"), "bin", "lo", "hi", "n")
        out = one if out is None else out.unionByName(one)
    return rounded(out)


# ---------------------------------------------------------------- 2.6 ratios
def _share_only(spark, sf, name: str) -> DataFrame:
    t = _t(spark, sf)
    spec = _spec(name)
    feats = aggregate_source(_lines(t), "l_orderkey", [spec], key_alias="report_id")
    return rounded(feats.where(F.col(spec.output_columns()[0]).isNotNull()))


for _name in ("el", "vi1", "vi2", "cons", "pt", "label"):
    REGISTRY[f"rat_{_name}"] = (lambda n: (lambda spark, sf: _share_only(spark, sf, n)))(_name)


@query("rat_exploded")
def q_rat_exploded(spark, sf):
    b = q_brg_el(spark, sf).withColumn("result", S.none_to_pass("result"))
    out = exploded_shares(b, "report_id", "result", ["Major", "Minor", "pass"],
                          {"Major": "el_maj", "Minor": "el_min", "pass": "el_pass"})
    return rounded(out)


# ---------------------------------------------------------------- 2.7 scalars
@query("fn_map_values")
def q_fn_map_values(spark, sf):
    b = q_brg_qa(spark, sf)
    return b.select("report_id", "line", S.map_values("service", B.SERVICE_BUCKETS).alias("service"))


@query("fn_none_to_pass")
def q_fn_none_to_pass(spark, sf):
    b = q_brg_el(spark, sf)
    return b.select("report_id", "line", S.none_to_pass("result").alias("result"))


@query("fn_rule_classify")
def q_fn_rule_classify(spark, sf):
    o = B.orders_view(_t(spark, sf))
    return o.select("report_id", F.col("final_result").alias("raw_result"),
                    S.classify_target("final_result").alias("final_result"))


@query("fn_keyword_country")
def q_fn_keyword_country(spark, sf):
    d = _t(spark, sf).documents
    return d.select("doc_id", S.keyword_country("text").alias("country"))


# The inspector ids kept by name; the rest become "other".
INSPECTOR_WHITELIST = [8, 5, 12, 15, 17, 1, 11]


@query("fn_whitelist_other")
def q_fn_whitelist_other(spark, sf):
    b = q_brg_inspector(spark, sf)
    return b.select("report_id", "line",
                    S.whitelist_other(F.col("inspector_id").cast("string"),
                                      [str(i) for i in INSPECTOR_WHITELIST]).alias("inspector"))


@query("fn_lower")
def q_fn_lower(spark, sf):
    o = B.orders_view(_t(spark, sf))
    return o.select("report_id", F.lower("final_result").alias("lower_result"))


@query("fn_contains")
def q_fn_contains(spark, sf):
    o = B.orders_view(_t(spark, sf))
    low = F.lower("final_result")
    return o.select("report_id", low.contains("not").alias("has_not"), low.contains("pass").alias("has_pass"))


@query("fn_is_nan")
def q_fn_is_nan(spark, sf):
    t = _t(spark, sf)
    rep = J.dim_join(B.orders_view(t), B.client_dim(t), "client_id", "client_id", ["manu_id"])
    return rep.select("report_id", F.col("manu_id").isNull().alias("manu_id_missing"))


@query("fn_zero_guard")
def q_fn_zero_guard(spark, sf):
    c = q_agg_count_pivot(spark, sf)
    d = F.col("n_maj_min") * 2 + F.col("n_major") + F.col("n_minor") + F.col("n_pass")
    return c.select("report_id", d.alias("denominator"), S.zero_guard(d).alias("guarded"))


@query("srt_desc")
def q_srt_desc(spark, sf):
    """Every column by falling missing rate (name breaks ties), with its place in that order."""
    rates = PR.null_rates(_labelled_master(spark, sf))  # one row a column
    place = F.row_number().over(Window.orderBy(F.col("miss_rate").desc(), "column_name"))
    return rounded(rates.withColumn("place", place).orderBy("place"))


@query("lim_first")
def q_lim_first(spark, sf):
    return J.first_per_key(B.address_lookup(_t(spark, sf)), "manu_id", "country", "_order")


# ---------------------------------------------------------------- 2.8 preparation / evaluation
from tessera.ml import adasyn as AD  # noqa: E402
from tessera.ml import prepare as PP  # noqa: E402


def _labelled_master(spark, sf) -> DataFrame:
    return build_master(_t(spark, sf)).dropna(subset=[B.TARGET])


@query("ml_dummies")
def q_ml_dummies(spark, sf):
    m = checkpoint(build_master(_t(spark, sf)).select("report_id", *B.CATEGORICAL_COLUMNS))  # read by dictionary and frame
    return PP.dummy_table(m, B.CATEGORICAL_COLUMNS)


@query("ml_label_encode")
def q_ml_label_encode(spark, sf):
    m = checkpoint(build_master(_t(spark, sf)).select("report_id", *B.CATEGORICAL_COLUMNS))  # read by dictionary and codes
    return PP.label_encode(m, B.CATEGORICAL_COLUMNS).drop(*B.CATEGORICAL_COLUMNS)


def numeric_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.name != "report_id"
            and isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType))]


@query("ml_impute_init")
def q_ml_impute_init(spark, sf):
    m = checkpoint(_labelled_master(spark, sf))
    out, _ = PP.impute_initial(m, numeric_features(m), B.CATEGORICAL_COLUMNS)
    return rounded(out)


@query("ml_split_stratified")
def q_ml_split_stratified(spark, sf):
    m = _labelled_master(spark, sf).select("report_id", B.TARGET)
    return PP.stratified_split(m, "report_id", B.TARGET, 0.1, seed=42)


EMB_DIMS = 64   # the whole embedding vector
EMB_COLS = [f"e{i}" for i in range(1, EMB_DIMS + 1)]
MINORITY_LABEL_BELOW = 3
ADASYN_K = 5
ADASYN_SEED = 11


def _embeddings(spark, sf) -> DataFrame:
    e = _t(spark, sf).embeddings
    return e.select("vec_id", "label", *[F.element_at("embedding", i).cast("double").alias(f"e{i}")
                                         for i in range(1, EMB_DIMS + 1)])


def _minority() -> F.Column:
    return F.col("label") < MINORITY_LABEL_BELOW


@query("ml_adasyn_hardness")
def q_ml_adasyn_hardness(spark, sf):
    return rounded(AD.adasyn_hardness(_embeddings(spark, sf), "vec_id", EMB_COLS, _minority(), ADASYN_K))


@query("ml_adasyn_samples")
def q_ml_adasyn_samples(spark, sf):
    return rounded(AD.adasyn_samples(_embeddings(spark, sf), "vec_id", EMB_COLS, _minority(), ADASYN_K,
                                     seed=ADASYN_SEED))


@query("ml_predict_threshold")
def q_ml_predict_threshold(spark, sf):
    s = _scored(spark, sf)
    return rounded(E.predict_threshold(s, "p_pass", 0.5).select("doc_id", "truth", "p_pass", "prediction"))


def _pred(spark, sf) -> DataFrame:
    return E.predict_threshold(_scored(spark, sf), "p_pass", 0.5)


@query("ml_confusion")
def q_ml_confusion(spark, sf):
    return E.confusion(_pred(spark, sf), "truth", "prediction")


@query("ml_precision_pair")
def q_ml_precision_pair(spark, sf):
    return rounded(E.precision_pair(_pred(spark, sf), "truth", "prediction"))


@query("ml_log_loss")
def q_ml_log_loss(spark, sf):
    return rounded(E.log_loss(_scored(spark, sf), "truth", "p_pass"))


@query("ml_classification_report")
def q_ml_classification_report(spark, sf):
    return rounded(E.classification_report(_pred(spark, sf), "truth", "prediction"))


@query("ml_threshold_sweep")
def q_ml_threshold_sweep(spark, sf):
    return rounded(E.threshold_sweep(_scored(spark, sf), "truth", "p_pass"))


# ---------------------------------------------------------------- 2.8 models (no SQL oracle)
from tessera.ml import impute as IM  # noqa: E402
from tessera.ml import lsh as LS  # noqa: E402
from tessera.ml import search as SE  # noqa: E402
from tessera.ml import train as TR  # noqa: E402
from tessera.ml import trees as TE  # noqa: E402

MODEL_THRESHOLD = 0.5
MODEL_SEED = 0
MODEL_ITER = 100
# Registered grid: the whole reference grid (720 points, which are 144 distinct fits).
QUERY_GRID = TE.REFERENCE_GRID
GRID_FOLDS = 6
GRID_ITER = 20
REPEAT_RUNS = 5
FITS_AT_ONCE = 6
MICE_ITERATIONS = 5
MICE_TREES, MICE_DEPTH = 5, 3
#: Feature sets: every feature, and the reference's variant without the columns derived from tests.
FEATURE_SETS = {"all": [], "without_tests": B.TEST_SHARE_COLUMNS}

# Materialised tables and fits shared by the model queries of one session, gone with it.

def _shared(spark, key, build):
    held = session_store(spark, "models")
    with held.setdefault(("lock", key), threading.Lock()):  # fits that overlap build what they share once
        if key not in held:
            held[key] = build()
    return held[key]


def _overlapped(make, wanted) -> list:
    """``make(*w)`` of each; their fits, each a distributed job of its own, overlap through driver threads."""
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return list(pool.map(lambda w: make(*w), wanted))


def _imputed(spark, sf) -> DataFrame:
    """The labelled master completed by MICE (the first data set, as the reference uses); the target predicts the other columns too."""
    def build():
        m = checkpoint(_labelled_master(spark, sf).drop("report_date"))  # read by several passes
        return IM.mice(m, "report_id", numeric_features(m), [*B.CATEGORICAL_COLUMNS, B.TARGET], iterations=MICE_ITERATIONS, datasets=1,
                       seed=MODEL_SEED, num_trees=MICE_TREES, max_depth=MICE_DEPTH)[0]
    return _shared(spark, ("imputed", sf), build)


@query("ml_mice")
def q_ml_mice(spark, sf):
    return rounded(_imputed(spark, sf))


def _frame(spark, sf, features="all"):
    return _shared(spark, ("frame", sf, features), lambda: TR.feature_frame(
        _imputed(spark, sf), "report_id", B.TARGET, B.CATEGORICAL_COLUMNS, exclude=FEATURE_SETS[features], imputed=True))


def _members(spark, sf) -> DataFrame:
    """Test sets of all seeds, from one scan."""
    return _shared(spark, ("members", sf), lambda: checkpoint(PP.seed_memberships(
        _frame(spark, sf)[0].select("report_id", TE.LABEL), "report_id", TE.LABEL, range(REPEAT_RUNS)).select("report_id", "tests")))


def _parts(spark, sf, seed=MODEL_SEED, features="all"):
    """The oversampled training rows and the test rows of one seed."""
    def build():
        marked = checkpoint(_frame(spark, sf, features)[0].join(_members(spark, sf), "report_id"))  # read by each step of the searches
        test = PP.in_test(F.col("tests"), seed)
        return TR.balanced(marked.where(~test), "report_id", seed=seed), checkpoint(marked.where(test).drop("tests"))
    return _shared(spark, ("parts", sf, seed, features), build)


def _grid(spark, sf):
    """(accuracy of each point, best point, accuracy of the default parameters)."""
    def build():
        data = TR.with_folds(_parts(spark, sf)[0], "report_id", GRID_FOLDS, MODEL_SEED)
        table, best, default = SE.grid_search(data, QUERY_GRID, GRID_FOLDS, GRID_ITER, MODEL_SEED, parallelism=FITS_AT_ONCE)
        return checkpoint(table), best, default
    return _shared(spark, ("grid", sf), build)


def _model(spark, sf, seed=MODEL_SEED, features="all"):
    """The boosted model of one seed's balanced training set, with the tuned parameters."""
    return _shared(spark, ("model", sf, seed, features), lambda: TR.fit_boosted(
        _parts(spark, sf, seed, features)[0], _grid(spark, sf)[1], MODEL_ITER, seed))


@query("ml_boosted_fit")
def q_ml_boosted_fit(spark, sf):
    scored = TR.scored(_model(spark, sf), _parts(spark, sf)[1])
    return rounded(scored.select("report_id", "truth", "p_pass", E.threshold_label(F.col("p_pass"), MODEL_THRESHOLD).alias("prediction")))


@query("ml_feature_importance")
def q_ml_feature_importance(spark, sf):
    frame, slots = _frame(spark, sf)
    return rounded(TR.feature_importance(_model(spark, sf), slots, frame))


def _run(spark, sf, seed: int, features="all") -> DataFrame:
    return TR.pipeline_run(_frame(spark, sf, features)[0], "report_id", MODEL_THRESHOLD, seed=seed,
                           parts=_parts(spark, sf, seed, features), model=_model(spark, sf, seed, features))


def _each_set(make) -> DataFrame:
    """Rows of each feature set, named."""
    out = None
    for name in FEATURE_SETS:
        one = make(name).withColumn("features", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("ml_pipeline_run")
def q_ml_pipeline_run(spark, sf):
    _overlapped(lambda features: _model(spark, sf, MODEL_SEED, features), [(f,) for f in FEATURE_SETS])
    return rounded(_each_set(lambda features: _run(spark, sf, MODEL_SEED, features)))


@query("ml_repeat_eval")
def q_ml_repeat_eval(spark, sf):
    _overlapped(lambda seed: _model(spark, sf, seed), [(s,) for s in range(REPEAT_RUNS)])
    runs = None
    for seed in range(REPEAT_RUNS):
        r = _run(spark, sf, seed)
        runs = r if runs is None else runs.unionByName(r)
    return rounded(E.run_stats(runs))


@query("ml_threshold_sweep_fitted")
def q_ml_threshold_sweep_fitted(spark, sf):
    """Each run's model is scored once and swept; mean metrics of each threshold over the runs."""
    _overlapped(lambda seed: _model(spark, sf, seed), [(s,) for s in range(REPEAT_RUNS)])
    runs = None
    for seed in range(REPEAT_RUNS):
        one = E.threshold_sweep(TR.scored(_model(spark, sf, seed), _parts(spark, sf, seed)[1]), "truth", "p_pass")
        runs = one if runs is None else runs.unionByName(one)
    metrics = [c for c in runs.columns if c not in ("threshold", "n_pred_pass")]
    return rounded(runs.groupBy("threshold").agg(F.sum("n_pred_pass").cast("long").alias("n_pred_pass"), F.count("*").alias("runs"),
                                                 *[F.avg(c).alias(c) for c in metrics]))


@query("ml_grid_search")
def q_ml_grid_search(spark, sf):
    return rounded(_grid(spark, sf)[0])


@query("ml_cv_compare")
def q_ml_cv_compare(spark, sf):
    table, _, default = _grid(spark, sf)
    tuned = table.agg(F.max("cv_accuracy")).first()[0]
    return rounded(spark.createDataFrame([("tuned", tuned), ("untuned", default)], "model string, cv_accuracy double"))


def _tree(spark, sf, features="all"):
    return _shared(spark, ("tree", sf, features), lambda: TR.decision_tree(_parts(spark, sf, MODEL_SEED, features)[0], 10, MODEL_SEED))


@query("ml_decision_tree")
def q_ml_decision_tree(spark, sf):
    def report(features):
        pred = _tree(spark, sf, features).transform(_parts(spark, sf, MODEL_SEED, features)[1]).select(
            TR.truth_col().alias("truth"), F.when(F.col("prediction") == 1.0, F.lit(E.POS)).otherwise(F.lit(E.NEG)).alias("prediction"))
        return E.classification_report(pred, "truth", "prediction")
    _overlapped(lambda features: _tree(spark, sf, features), [(f,) for f in FEATURE_SETS])
    return rounded(_each_set(report))


@query("ml_tree_rules")
def q_ml_tree_rules(spark, sf):
    return rounded(TR.tree_rules(_tree(spark, sf), _parts(spark, sf)[0], _frame(spark, sf)[1]))


LSH_BUCKET = 0.5
LSH_TABLES = 12


@query("ml_lsh_neighbours")
def q_ml_lsh_neighbours(spark, sf):
    """Approximate neighbours of the minority rows among all rows."""
    points = _embeddings(spark, sf)
    return rounded(LS.lsh_neighbours(points.where(_minority()), points, "vec_id", EMB_COLS, ADASYN_K, LSH_BUCKET, LSH_TABLES, MODEL_SEED))
