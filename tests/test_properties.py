"""Random small panels against pandas."""

from datetime import date, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lagscope.operators import drop_latest, resample, with_changes

ROW = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.integers(0, 1200),
    st.one_of(st.none(), st.integers(-50, 50)),
)
PANEL = st.lists(ROW, min_size=1, max_size=60, unique_by=lambda r: r[:2])
some = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def frames(spark, panel):
    rows = [(k, date(2019, 11, 1) + timedelta(days=d), None if v is None else float(v)) for k, d, v in panel]
    pdf = pd.DataFrame(rows, columns=["k", "date", "v"]).sort_values(["k", "date"])
    pdf["period"] = [f"{d.year}-Q{(d.month + 2) // 3}" for d in pdf["date"]]
    return spark.createDataFrame(rows, "k string, date date, v double").repartition(3), pdf


def plain(value):
    return None if value is None or value != value else value


@some
@given(panel=PANEL)
@pytest.mark.parametrize("rule", ["last", "sum", "avg"])
def test_resample(spark, rule, panel):
    df, pdf = frames(spark, panel)
    groups = pdf.groupby(["k", "period"])["v"]
    if rule == "last":
        expected = groups.apply(lambda v: v.iloc[-1])
    else:
        expected = groups.sum(min_count=1) if rule == "sum" else groups.mean()
    found = {(r["k"], r["year_quarter"]): r["v"] for r in resample(df, "quarter", rule, "v", keys=["k"]).collect()}
    assert set(found) == set(expected.index)
    for key, value in expected.items():
        assert plain(found[key]) == pytest.approx(plain(value))


@some
@given(panel=PANEL)
def test_change_and_latest_period(spark, panel):
    df, pdf = frames(spark, panel)
    quarters = resample(df, "quarter", "last", "v", keys=["k"])
    changed = drop_latest(with_changes(quarters, "v", {"c": 4}, ["year", "quarter"], ["k"]), "year_quarter", ["k"])
    found = {(r["k"], r["year_quarter"]): r["c"] for r in changed.collect()}
    expected = {}
    for k, group in pdf.groupby("k"):
        last = [(p, plain(g["v"].iloc[-1])) for p, g in group.groupby("period")]
        for i, (period, value) in enumerate(last[:-1]):
            before = last[i - 4][1] if i >= 4 else None
            expected[k, period] = (value / before - 1) * 100 if before and value is not None else None
    assert set(found) == set(expected)
    for key, value in expected.items():
        assert found[key] == pytest.approx(value)
