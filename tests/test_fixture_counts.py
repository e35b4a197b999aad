"""Counts published with the fixture bindings (computed independently of
this code) at sf0.01."""

from pyspark.sql import functions as F

from folders import SF_MID
from lifeline.config import SyncConfig
from lifeline.functions.dates import local_date
from lifeline.operators import state
from lifeline.operators.identity import first_touch_state
from lifeline.plans import events_job, state_job
from lifeline.sources.inputs import load_testdata

CFG = SyncConfig()


def test_fixture_counts(spark):
    inp = load_testdata(spark, SF_MID, CFG)
    status = {r.subscription_status: r.n_states
              for r in state.status_counts(state_job.state_rows(inp, CFG)).collect()}
    assert status == {"active": 211, "churn voluntary": 156, "churn involuntary": 509,
                      "churn unknown": 1349, "in cancelation period": 326, "unknown": 15}

    st = first_touch_state(inp.analytics.all())
    kinds = {(r.app, r.client): r["count"] for r in st.select(
        F.col("first_app.value").isNotNull().alias("app"),
        F.col("first_client.value").isNotNull().alias("client"),
    ).groupBy("app", "client").count().collect()}
    assert kinds == {(True, True): 83, (True, False): 4, (False, True): 58, (False, False): 5}

    in_range = inp.analytics.between(*CFG.state_shard_range).select("user_id").distinct().count()
    assert in_range == 133

    day = inp.subscription_events.where(
        local_date(F.col("event_ts"), CFG.zone) == F.lit(CFG.yesterday_local))
    assert day.count() == 330
    assert events_job.day_events(inp, CFG).select("user_id").distinct().count() == 135
