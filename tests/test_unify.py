"""Unification semantics and plan shape."""

import os

import pandas as pd
import pytest

from firmlink.config import MatchConfig
from firmlink.plans.unify import unify
from tests.conftest import SF01

REG = [
    ("1", "Acme Pty Ltd", "PRV", "1 St", "2000", "NSW"),
    ("2", "Globex Corporation", "PUB", None, "3000", "VIC"),
    (None, "Initech Limited", None, None, None, None),
    ("4", "Umbrella Holdings", "PRV", None, None, "QLD"),
    ("5", "Acme", "IND", None, None, None),
]
CRAWL = [
    ("acme.com", "ACME", "Mining"),
    ("acme.com", "Acme Co", None),
    ("globex.io", "Globex", "Energy"),
    ("initech.net", "Initech Lt", "Software"),
    ("umbrella.org", "Umbrella Holdin", "Pharma"),
]


def _inputs(spark):
    reg = spark.createDataFrame(REG, "abn string, entity_name string, entity_type string, address string, "
                                     "postcode string, state string")
    cc = spark.createDataFrame(CRAWL, "domain string, extracted_name string, extracted_industry string")
    return reg, cc


def _rows(df):
    return sorted(((r.abn, r.domain, r.match_type, r.extracted_industry) for r in df.collect()), key=str)


def test_exact_and_high(spark):
    reg, cc = _inputs(spark)
    out = unify(reg, cc, with_timestamp=False)
    assert _rows(out) == sorted([
        ("1", "acme.com", "EXACT", None),
        ("5", "acme.com", "EXACT", None),
        ("2", "globex.io", "EXACT", "Energy"),
    ], key=str)


def test_verdicts_and_null_abn(spark):
    reg, cc = _inputs(spark)
    verdicts = spark.createDataFrame(
        [("umbrella holdings", "umbrella holdin", " YES, same"), ("initech", "initech lt", "yes")],
        "reg_norm string, crawl_norm string, answer string")
    out = unify(reg, cc, verdicts=verdicts, with_timestamp=False)
    rows = _rows(out)
    assert ("4", "umbrella.org", "FUZZY_LLM", "Pharma") in rows
    # a confirmed pair needs a registry key
    assert not any(r[1] == "initech.net" for r in rows)
    assert "processed_at" in unify(reg, cc).columns


def test_confirmer_function_with_limit(spark, tmpdir_fresh):
    reg, cc = _inputs(spark)
    log = os.path.join(tmpdir_fresh, "asked.txt")

    def confirmer(pdf: pd.DataFrame) -> pd.Series:
        # runs in a Python worker: record each question in a file
        with open(log, "a") as fh:
            for r in pdf.itertuples(index=False):
                fh.write(f"{r.reg_norm}|{r.crawl_norm}\n")
        return pd.Series(["Yes"] * len(pdf))

    with pytest.warns(UserWarning, match="1 borderline pairs are not asked"):
        out = unify(reg, cc, MatchConfig(confirm_limit=1), confirmer=confirmer, with_timestamp=False)
    assert ("4", "umbrella.org", "FUZZY_LLM", "Pharma") in _rows(out)
    out.count()
    # the best-scoring borderline pair only (cap 1), asked once however often the plan runs
    assert open(log).read().splitlines() == ["umbrella holdings|umbrella holdin"]
    with pytest.warns(UserWarning, match="2 borderline pairs"):
        none = unify(reg, cc, MatchConfig(confirm_limit=0), confirmer=confirmer, with_timestamp=False)
    assert not any(r[2] == "FUZZY_LLM" for r in _rows(none))


def test_all_borderline_pairs_are_asked_in_parallel(spark):
    from pyspark.sql import functions as F

    from firmlink.operators.confirm import apply_verdicts

    scored = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("r_norm"), F.concat(F.lit("c"), "id").alias("c_norm"),
                                      F.lit(0.9).alias("fuzzy_score"))
    def all_yes(pdf):
        return pdf["reg_norm"].map(lambda _: "yes")

    judged = apply_verdicts(scored, MatchConfig(), confirmer=all_yes)
    assert judged.where("confirmed").count() == 5000
    asked = judged.join(scored, ["r_norm", "c_norm"]).inputFiles()
    assert len(asked) > 1  # the answers were written by several tasks


def test_partitioning_independent_and_plan_shape(spark):
    from firmlink.fixtures import unify_inputs, verdict_table
    from firmlink.plans.unify import match_stages

    reg, cc = unify_inputs(spark, SF01)
    v = verdict_table(reg, cc)
    a = unify(reg.repartition(1), cc.repartition(1), verdicts=v, with_timestamp=False)
    b = unify(reg.repartition(7), cc.repartition(5, "domain"), verdicts=v, with_timestamp=False)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    plan = a._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    from firmlink.config import MatchConfig
    from firmlink.operators.match import score_pairs

    scoring = score_pairs(match_stages(reg, cc).candidates, MatchConfig())
    scoring.write.format("noop").mode("overwrite").save()
    splan = scoring._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert splan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in splan
    assert "CartesianProduct" not in splan and "BroadcastNestedLoopJoin" not in splan


def test_empty_and_null_name_inputs(spark):
    reg, cc = _inputs(spark)
    empty_reg = reg.limit(0)
    empty_cc = cc.limit(0)
    assert unify(empty_reg, cc, with_timestamp=False).count() == 0
    assert unify(reg, empty_cc, with_timestamp=False).count() == 0
    nulls = spark.createDataFrame([("9", "Pty Ltd", None, None, None, None), ("8", None, None, None, None, None)],
                                  reg.schema)
    assert unify(nulls, cc, with_timestamp=False).count() == 0
