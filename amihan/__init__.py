"""amihan: anti-money-laundering compliance analytics as Spark DataFrame jobs.

Layers: ``sources`` (raw tables, seeds, sinks) -> ``operators`` (bronze
normalisers, silver detections and scores, data-quality checks) -> ``plans``
(gold marts, reports, the daily run).  ``functions`` holds the column
expressions they share.
"""

from amihan.params import AmlParams

__all__ = ["AmlParams"]
