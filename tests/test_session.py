"""Runtime settings: tasks on tables take in a bounded share, whatever the size of the tables."""

from tradewind.checks import registry
from tradewind.session import TABLE_CONF


def test_every_query_on_tables_runs_with_bounded_tasks(spark):
    was = {k: spark.conf.get(k) for k in TABLE_CONF}
    seen = {}
    try:
        for k in TABLE_CONF:
            spark.conf.unset(k)
        registry.query("zz_settings")(lambda t: seen.update({k: t.spark.conf.get(k) for k in TABLE_CONF}))
        registry.QUERIES.pop("zz_settings")(spark, "nowhere")
        assert seen == TABLE_CONF
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
