"""End-to-end flow on a synthetic claims table built from the contract (the
studied code ships no data file)."""

import datetime as dt
import random

import pytest

from tabrix.operators.contract import CLAIMS_COLUMNS, CLAIMS_NUMERICAL
from tabrix.operators.quality import ValidationFailed
from tabrix.plans.flow import FlowConfig, training_flow

WORDS = ["craft-repair", "machine-op-inspct", "sales", "exec-managerial", "chess", "reading",
         "golf", "Columbus", "Arlington", "Saab", "Dodge", "Audi", "92x", "RAM", "A5"]


def _claims(n=240, seed=7, dirty=False):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        fraud = "Y" if rnd.random() < 0.3 else "N"
        bind = dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 5000))
        inc = bind + dt.timedelta(days=rnd.randint(1, 3000))
        inj, prop, veh = rnd.randint(0, 9) * 1000, rnd.randint(0, 9) * 1000, rnd.randint(1, 40) * 1000
        r = {c: None for c in CLAIMS_COLUMNS}
        for c in CLAIMS_NUMERICAL:
            r[c] = rnd.randint(0, 500)
        r.update({
            "months_as_customer": rnd.randint(0, 480) + (120 if fraud == "Y" else 0),
            "age": rnd.randint(19, 64), "policy_number": 100000 + i,
            "incident_hour_of_the_day": rnd.randint(0, 23),
            "number_of_vehicles_involved": rnd.randint(1, 4), "bodily_injuries": rnd.randint(0, 2),
            "witnesses": rnd.randint(0, 3), "auto_year": rnd.randint(1995, 2015),
            "injury_claim": inj, "property_claim": prop, "vehicle_claim": veh,
            "total_claim_amount": inj + prop + veh,
            "policy_bind_date": bind.isoformat(), "incident_date": inc.isoformat(),
            "fraud_reported": fraud,
        })
        for c in CLAIMS_COLUMNS:
            if r[c] is None:
                r[c] = rnd.choice(WORDS)
        r["insured_sex"] = rnd.choice(["MALE", "female", " m "])
        r["property_damage"] = rnd.choice(["YES", "NO", "?", "yes"])
        r["incident_severity"] = "Major Damage" if fraud == "Y" and rnd.random() < 0.7 else "Minor Damage"
        if dirty and i % 3 == 0:
            r["age"] = 150
        rows.append(tuple(r[c] for c in CLAIMS_COLUMNS))
    return rows


def _frame(spark, **kw):
    from pyspark.sql import types as T

    fields = [T.StructField("claim_id", T.LongType())] + [
        T.StructField(c, T.LongType() if c in CLAIMS_NUMERICAL else T.StringType())
        for c in CLAIMS_COLUMNS]
    data = [(i, *r) for i, r in enumerate(_claims(**kw))]
    return spark.createDataFrame(data, T.StructType(fields))


def test_training_flow_end_to_end(spark):
    from dataclasses import replace

    from tabrix.operators.contract import CLAIMS_CONTRACT

    contract = replace(CLAIMS_CONTRACT, columns=CLAIMS_CONTRACT.columns)
    res = training_flow(_frame(spark), FlowConfig(key="claim_id", contract=contract, folds=3))
    s = {r["dataset"]: r["status"] for r in res.summary.collect()}
    assert s["__all__"] is True
    assert res.labels == ["N", "Y"]
    assert res.train.columns[-1] == "fraud_reported" and "combined_text" in res.train.columns
    assert "policy_to_incident_days" in res.manifest["numeric_columns"]
    assert "capital_gains" in res.train.columns
    m = {r["metric"]: r["value"] for r in res.metrics.collect()}
    assert m["auc"] > 0.7
    assert res.predictions.count() + res.train.count() == 240
    assert res.search_summary.count() == 2
    assert res.drift_summary.first()["n_features"] > 30
    sex = {r[0] for r in res.train.select("insured_sex").distinct().collect()}
    assert sex <= {"MALE", "FEMALE"}


def test_flow_gate_refuses_dirty_data(spark):
    with pytest.raises(ValidationFailed):
        training_flow(_frame(spark, dirty=True), FlowConfig(key="claim_id", folds=3))
