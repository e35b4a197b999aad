"""SQL over the registered views equals the DataFrame stages."""

from folders import SF_SMALL
from lifeline.config import SyncConfig
from lifeline.plans import state_job
from lifeline.plans.views import register_views
from lifeline.sources.inputs import load_testdata

CFG = SyncConfig()


def test_views(spark):
    inp = load_testdata(spark, SF_SMALL, CFG)
    names = register_views(spark, inp, CFG)
    assert "lifeline_subscription_state" in names
    sql = spark.sql(
        "SELECT * FROM lifeline_state_rows WHERE subscription_status IN ('active', 'churn unknown')")
    df = state_job.state_with_identity(inp, CFG).where(
        "subscription_status IN ('active', 'churn unknown')")
    assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0
    n = spark.sql("SELECT count(*) AS n FROM lifeline_analytics_events WHERE suffix = '20240130'").first().n
    assert n == inp.analytics.between("20240130", "20240130").count()
