"""Queries over ``events``: windowed features, rollups, drift windows, dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklab.operators import features as feat
from sparklab.plans.registry import query
from sparklab.sources.tables import Tables

# Fixed fixture parameters: events cover 2024-01-01 .. 2024-01-30.
AS_OF = "2024-01-31"


@query("windowed_countif", sql="""
SELECT user_id,
       CAST(count_if(CAST(ts AS DATE) > DATE '2024-01-31' - 7) AS BIGINT)  AS events_7d,
       CAST(count_if(CAST(ts AS DATE) > DATE '2024-01-31' - 14) AS BIGINT) AS events_14d,
       CAST(count_if(CAST(ts AS DATE) > DATE '2024-01-31' - 28) AS BIGINT) AS events_28d,
       CAST(count_if(event_type = 'error' AND CAST(ts AS DATE) > DATE '2024-01-31' - 14) AS BIGINT) AS errors_14d,
       CAST(count_if(event_type = 'purchase' AND CAST(ts AS DATE) > DATE '2024-01-31' - 14) AS BIGINT) AS purchases_14d,
       max(CAST(ts AS DATE)) AS last_event_date,
       CAST(date_diff('day', max(CAST(ts AS DATE)), DATE '2024-01-31') AS INTEGER) AS days_since_last_event,
       count_if(CAST(ts AS DATE) > DATE '2024-01-31' - 7)
         / nullif(count_if(CAST(ts AS DATE) > DATE '2024-01-31' - 28) / 4.0, 0) AS activity_ratio_7d_vs_avg
FROM events
WHERE CAST(ts AS DATE) <= DATE '2024-01-31'
GROUP BY user_id
""")
def q_windowed_countif(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return feat.windowed_counts(
        t.events, "user_id", "ts", AS_OF, windows=(7, 14, 28), type_col="event_type",
        typed={"errors_14d": ("error", 14), "purchases_14d": ("purchase", 14)}, ratio=(7, 28))
