"""Binding of the inspection data model onto the driver's TPC-H-style tables.

=====================  ===================================================
inspection concept     driver tables
=====================  ===================================================
report (entity)        ``orders``: o_orderkey = report_id, o_orderdate = report_date,
                       o_orderstatus = product_name, o_orderpriority -> raw final result
client dimension       ``customer`` on o_custkey: c_mktsegment = client std name;
                       manufacturer id = nullif(c_nationkey, 7) (null path),
                       raw address = name of the customer's nation
manufacturer dim       ``nation`` (bounded: 25 rows) -> manufacturer std name
address lookup         ``nation`` x ``region`` -> country = region name
bridge + dimension     ``lineitem`` LEFT JOIN ``part`` (the part key of lines 6 is read as null, so
                       they have no dimension row) LEFT JOIN ``supplier``
test results           derived from l_returnflag / l_linestatus / l_linenumber,
                       null when the line has no part row
phase                  l_linestatus: O -> 1, F -> 2
=====================  ===================================================

Result encodings are declared once as (condition, value) lists and rendered
both as Spark columns and as SQL text for the oracle; conditions only use
syntax that both engines parse the same way.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import map_values, none_to_pass
from tessera.operators.shares import ShareRule
from tessera.plans.features import FeatureSpec
from tessera.session import session_store
from tessera.sources.tables import read_table

LIST_MAJ_MIN = "['Major', 'Minor']"

# (SQL condition, value) pairs; the first true condition wins; else null.
# Every encoding is null when the line has no part row.
NO_DIM = "p_partkey IS NULL"
RESULTS: dict[str, list[tuple[str, str | None]]] = {
    "el": [
        (NO_DIM, None),
        ("l_returnflag = 'R' AND l_linestatus = 'F'", LIST_MAJ_MIN),
        ("l_returnflag = 'R'", "Major"),
        ("l_returnflag = 'A'", "Minor"),
        ("l_returnflag = 'N' AND l_linenumber <= 4", "None"),
    ],
    "vi": [],
    "cons": [
        (NO_DIM, None),
        ("l_returnflag = 'N' AND l_linestatus = 'O'", "Approved"),
        ("l_returnflag = 'A'", "Not applicable"),
        ("l_returnflag = 'R' AND l_linenumber <= 2", "None"),
    ],
    "pt": [
        (NO_DIM, None),
        ("l_returnflag = 'N' AND l_linestatus = 'O'", "Conformed"),
        ("l_returnflag = 'N' AND l_linestatus = 'F'", "Not conformed"),
        ("l_returnflag = 'A'", "Not applicable"),
        ("l_returnflag = 'R' AND l_linestatus = 'F'", "Partly conformed"),
        ("l_returnflag = 'R' AND l_linenumber <= 3", "None"),
    ],
    "label": [
        (NO_DIM, None),
        ("l_returnflag = 'N'", "Conformed"),
        ("l_returnflag = 'A'", "Not conformed"),
        ("l_returnflag = 'R' AND l_linenumber = 1", "None"),
    ],
}
RESULTS["vi"] = list(RESULTS["el"])   # visual inspection uses the EL severity scale
PHASE_SQL = "CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_linestatus = 'F' THEN 2 END"
TECH_SQL = "CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END"
FINAL_RESULT_CASES = [
    ("o_orderpriority = '5-LOW'", None),
    ("o_orderpriority = '1-URGENT'", "Pass"),
    ("o_orderpriority = '3-MEDIUM'", "Pass with remarks"),
]
NULL_MANUFACTURER = 7
# Bridge rows without a dimension row: lines whose part key is read as null.
PART_KEY_SQL = "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_partkey END"

# Category buckets of the service feature (the reference merges look-alike services).
SERVICE_BUCKETS = {"ECONOMY/STANDARD": ["ECONOMY", "STANDARD"], "PROMO/LARGE": ["PROMO", "LARGE"]}
SERVICE_DOMAIN = ["ECONOMY/STANDARD", "MEDIUM", "PROMO/LARGE", "SMALL"]
TECH_DOMAIN = ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]
REGION_DOMAIN = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
SEVERITY_DOMAIN = [LIST_MAJ_MIN, "Major", "Minor", "pass"]


def case_column(cases: Sequence[tuple[str, str | None]], default: Column | None = None) -> Column:
    out = None
    for cond, val in cases:
        lit = F.lit(val).cast("string")
        out = F.when(F.expr(cond), lit) if out is None else out.when(F.expr(cond), lit)
    return out.otherwise(default if default is not None else F.lit(None).cast("string"))


def _sql_lit(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def case_sql(cases: Sequence[tuple[str, str | None]], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {_sql_lit(v)}" for c, v in cases) + f" ELSE {default} END"


def _slug(v: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in v.lower()).strip("_")


# ---------------------------------------------------------------------------
# Tables

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "labels", "documents", "embeddings")


class Tables:
    """Lazy scans of the driver tables under one directory.

    Scan DataFrames are shared by all queries of one session (a catalog of
    lazy relations: no data is cached, only the file listing and schema), and
    go with it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        held = session_store(self.spark, "scans")
        key = (self.sf_dir, name)
        if key not in held:
            held[key] = read_table(self.spark, self.sf_dir, name)
        return held[key]


def orders_view(t: Tables) -> DataFrame:
    """The report table as the extractor sees it."""
    return t.orders.select(
        F.col("o_orderkey").alias("report_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").alias("report_date"),
        F.col("o_orderstatus").alias("product_name"),
        case_column(FINAL_RESULT_CASES, F.col("o_orderpriority")).alias("final_result"),
    )


def client_dim(t: Tables) -> DataFrame:
    """customer -> client std name, manufacturer id (with a null path) and the
    raw address text."""
    nation = t.nation.select(F.col("n_nationkey").alias("__nk"), F.col("n_name").alias("manu_add"))
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return (c.join(nation, c["c_nationkey"] == nation["__nk"], "left")
            .select(F.col("c_custkey").alias("client_id"),
                    F.col("c_mktsegment").alias("client_std_name"),
                    F.nullif(F.col("c_nationkey"), F.lit(NULL_MANUFACTURER)).alias("manu_id"),
                    F.col("manu_add")))


def manufacturer_dim(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("manu_id"), F.col("n_name").alias("manu_std_name"))


def address_lookup(t: Tables) -> DataFrame:
    """(manu_id, country, _order): the address sheet, in file order.  One row a supplier, so a
    manufacturer has many rows with different countries and the first one counts."""
    s = t.supplier.select("s_suppkey", "s_nationkey")
    r = t.region.select("r_regionkey", "r_name")
    return (s.join(r, F.pmod(s["s_suppkey"], F.lit(5)) == r["r_regionkey"], "left")
            .select(F.col("s_nationkey").alias("manu_id"), F.col("r_name").alias("country"),
                    F.col("s_suppkey").cast("long").alias("_order")))


def line_bridge(t: Tables, with_supplier: bool = True, with_part: bool = True) -> DataFrame:
    """lineitem [LEFT JOIN part] [LEFT JOIN supplier x nation x region]: the
    shared bridge of every test / service / technology / inspector feature.

    No broadcast hints: a side is broadcast only if its size is under the threshold.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_returnflag", "l_linestatus")
    out = li
    if with_part:
        p = t.part.select("p_partkey", "p_type")
        out = li.withColumn("__pk", F.expr(PART_KEY_SQL)).join(p, F.col("__pk") == p["p_partkey"], "left").drop("__pk")
    if with_supplier:
        s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
        geo = (t.nation.select("n_nationkey", "n_regionkey").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.col("n_nationkey").alias("__snk"), F.col("r_name").alias("insp_region")))
        out = (out.join(s, out["l_suppkey"] == s["s_suppkey"], "left")
               .join(geo, F.col("s_nationkey") == F.col("__snk"), "left").drop("__snk"))
    return out


SUPPLIER_COLUMNS = ("insp_region", "s_name")
LINE_COLUMNS = (None, *SUPPLIER_COLUMNS)   # spec values that need no part row


def with_results(bridge: DataFrame) -> DataFrame:
    """Add the encoded result columns and the phase to a line bridge."""
    cols = {"phase": F.expr(PHASE_SQL)}
    if "p_partkey" in bridge.columns:
        cols.update({f"{k}_result": case_column(v) for k, v in RESULTS.items()})
        cols["service"] = F.col("p_type")
        cols["technology"] = F.expr(TECH_SQL)
    return bridge.withColumns(cols)


# ---------------------------------------------------------------------------
# Feature specs (one row per feature group of the master table)

def _severity_spec(name: str, value: str, where: str | None) -> FeatureSpec:
    cols = {LIST_MAJ_MIN: f"{name}_maj_min", "Major": f"{name}_maj_n", "Minor": f"{name}_min_n",
            "pass": f"{name}_pass_n"}
    rule = ShareRule(
        numerators={f"{name}_maj": [f"{name}_maj_n", f"{name}_maj_min"],
                    f"{name}_min": [f"{name}_min_n", f"{name}_maj_min"],
                    f"{name}_pass": [f"{name}_pass_n"]},
        weights={f"{name}_maj_min": 2})
    return FeatureSpec(name=name, source="lines", kind="share", value=value,
                       domain=SEVERITY_DOMAIN, columns=cols, where=where, share=rule,
                       remap=none_to_pass)


def _plain_share_spec(name: str, value: str, domain_cols: Mapping[str, str]) -> FeatureSpec:
    counts = {v: f"{c}_n" for v, c in domain_cols.items()}
    rule = ShareRule(numerators={c: [f"{c}_n"] for c in domain_cols.values()})
    return FeatureSpec(name=name, source="lines", kind="share", value=value,
                       domain=list(domain_cols), columns=counts, share=rule)


def feature_specs() -> list[FeatureSpec]:
    return [
        FeatureSpec("qa", "lines", "indicator_max", value="service", domain=SERVICE_DOMAIN,
                    columns={v: f"qa_{_slug(v)}" for v in SERVICE_DOMAIN},
                    remap=lambda c: map_values(c, SERVICE_BUCKETS)),
        FeatureSpec("celltech", "lines", "indicator_max", value="technology", domain=TECH_DOMAIN,
                    columns={v: f"celltech_{_slug(v)}" for v in TECH_DOMAIN}),
        FeatureSpec("ins", "lines", "indicator_sum", value="insp_region", domain=REGION_DOMAIN,
                    columns={v: f"ins_{_slug(v)}" for v in REGION_DOMAIN}),
        _severity_spec("el", "el_result", None),
        _severity_spec("vi1", "vi_result", "phase = 1"),
        _severity_spec("vi2", "vi_result", "phase = 2"),
        _plain_share_spec("cons", "cons_result", {"Approved": "cons_approve", "Not applicable": "cons_na"}),
        _plain_share_spec("pt", "pt_result", {"Conformed": "pt_conformed", "Not conformed": "pt_not_conformed",
                                              "Not applicable": "pt_na", "Partly conformed": "pt_half_conformed"}),
        _plain_share_spec("label", "label_result", {"Conformed": "label_conformed",
                                                    "Not conformed": "label_not_conformed"}),
        FeatureSpec("cert1", "lines", "row_count", where="phase = 1", default=0, output="cert1"),
    ]


# The reference's "without tests" variant drops exactly the share columns.
TEST_SHARE_COLUMNS = [c for s in feature_specs() if s.kind == "share" for c in s.output_columns()]
CATEGORICAL_COLUMNS = ["product_name", "manu_add", "manu_std_name", "client_std_name"]
TARGET = "final_result"
