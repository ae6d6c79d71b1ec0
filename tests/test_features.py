"""Feature groups on synthetic bridge rows (FIXTURES §4); quirks carry their number."""
import pytest
from pyspark.sql import functions as F

from tessera.functions.scalars import none_to_pass
from tessera.operators.shares import ShareRule, exploded_shares
from tessera.plans.features import FeatureSpec, attach_specs

MM = "['Major', 'Minor']"


def el_spec(where=None, name="el", value="result"):
    cols = {MM: f"{name}_mm", "Major": f"{name}_maj_n", "Minor": f"{name}_min_n", "pass": f"{name}_pass_n"}
    rule = ShareRule(numerators={f"{name}_maj": [f"{name}_maj_n", f"{name}_mm"],
                                 f"{name}_min": [f"{name}_min_n", f"{name}_mm"],
                                 f"{name}_pass": [f"{name}_pass_n"]}, weights={f"{name}_mm": 2})
    return FeatureSpec(name, "b", "share", value=value, domain=[MM, "Major", "Minor", "pass"], columns=cols,
                       share=rule, where=where, remap=none_to_pass)


@pytest.fixture()
def reports(spark):
    return spark.createDataFrame([(i,) for i in range(1, 6)], "report_id long")


@pytest.fixture()
def bridge(spark):
    rows = [(1, "pass", 1), (1, "Major", 1), (1, MM, 2), (2, None, 1), (3, "Minor", 2), (3, None, 2),
            (5, "None", 1)]
    return spark.createDataFrame(rows, "rid long, result string, phase int")


def collect(df, key="report_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_share_semantics_q1(spark, reports, bridge):
    out = collect(attach_specs(reports, "report_id", {"b": (bridge, "rid")}, [el_spec()]))
    assert (out[1]["el_maj"], out[1]["el_min"], out[1]["el_pass"]) == (0.5, 0.25, 0.25)
    assert (out[2]["el_maj"], out[2]["el_min"], out[2]["el_pass"]) == (0.0, 0.0, 0.0)      # present, all null
    assert (out[3]["el_maj"], out[3]["el_min"], out[3]["el_pass"]) == (0.0, 1.0, 0.0)
    assert (out[4]["el_maj"], out[4]["el_min"], out[4]["el_pass"]) == (None, None, None)  # absent -> null
    assert out[5]["el_pass"] == 1.0                                                         # "None" -> pass (Q3)


def test_phase_filter_presence(spark, reports, bridge):
    out = collect(attach_specs(reports, "report_id", {"b": (bridge, "rid")}, [el_spec("phase = 2", "vi2")]))
    assert (out[1]["vi2_maj"], out[1]["vi2_min"], out[1]["vi2_pass"]) == (0.5, 0.5, 0.0)   # d = 2 * mm
    assert out[2]["vi2_maj"] is None                                                        # no phase-2 rows


def test_none_not_counted_without_remap_q2(spark, reports):
    b = spark.createDataFrame([(1, "None"), (1, "Approved"), (2, "None")], "rid long, result string")
    spec = FeatureSpec("cons", "b", "share", value="result", domain=["Approved", "Not applicable"],
                       columns={"Approved": "a_n", "Not applicable": "na_n"},
                       share=ShareRule(numerators={"cons_approve": ["a_n"], "cons_na": ["na_n"]}))
    out = collect(attach_specs(reports, "report_id", {"b": (b, "rid")}, [spec]))
    assert out[1]["cons_approve"] == 1.0
    assert (out[2]["cons_approve"], out[2]["cons_na"]) == (0.0, 0.0)                        # row stays: present


def test_indicator_null_is_zero_q5_and_default_q4(spark, reports):
    b = spark.createDataFrame([(1, "x", 1), (1, None, 1), (2, None, 2), (2, "y", 1), (2, "y", 1)],
                              "rid long, v string, phase int")
    specs = [FeatureSpec("ind", "b", "indicator_max", value="v", domain=["x", "y"], columns={"x": "ix", "y": "iy"}),
             FeatureSpec("cnt", "b", "indicator_sum", value="v", domain=["x", "y"], columns={"x": "cx", "y": "cy"}),
             FeatureSpec("cert1", "b", "row_count", where="phase = 1", default=0, output="cert1")]
    out = collect(attach_specs(reports, "report_id", {"b": (b, "rid")}, specs))
    assert (out[1]["ix"], out[1]["iy"], out[2]["ix"], out[2]["iy"]) == (1, 0, 0, 1)
    assert (out[2]["cx"], out[2]["cy"]) == (0, 2)
    assert out[3]["ix"] is None and out[3]["cert1"] == 0                                    # Q4: 0, not null
    assert (out[1]["cert1"], out[2]["cert1"]) == (2, 2)


def test_exploded_equals_closed_form(spark, reports, bridge):
    closed = collect(attach_specs(reports, "report_id", {"b": (bridge, "rid")}, [el_spec()]))
    b = bridge.withColumn("result", none_to_pass("result"))
    ex = collect(exploded_shares(b, "rid", "result", ["Major", "Minor", "pass"],
                                 {"Major": "el_maj", "Minor": "el_min", "pass": "el_pass"}), key="rid")
    for rid, row in ex.items():
        for c in ("el_maj", "el_min", "el_pass"):
            assert abs(row[c] - closed[rid][c]) < 1e-12


def test_partitioning_does_not_change_results(spark, reports, bridge):
    a = attach_specs(reports.repartition(1), "report_id", {"b": (bridge.repartition(1), "rid")}, [el_spec()])
    b = attach_specs(reports.repartition(7), "report_id", {"b": (bridge.repartition(8), "rid")}, [el_spec()])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
