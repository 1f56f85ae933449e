"""hitparade — daily chart-snapshot analytics on Spark.

Landed catalogue responses (genre charts and artist records) are flattened,
deduplicated in first-seen order, shaped into a date-partitioned star schema
(popularity fact + title, artist and calendar dimensions), gated by
distributed data-quality rules, published with per-date idempotent overwrites
and queried by dashboard reports. Everything is DataFrame/SQL; the library
never chooses a master or pulls data to the driver.
"""

from hitparade.operators.star import Star

__all__ = ["Star"]
