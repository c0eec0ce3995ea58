"""orderlens: order-outcome analytics as Spark DataFrame / SQL / MLlib jobs.

Layers
------
sources/    readers and writers: the order table, the city dictionary,
            saved contexts and models, and the ``leads`` view derived from
            the driver's TPC-H-style tables.
functions/  ``Column -> Column`` feature operators and the op registry.
operators/  relational building blocks: cleaning, the prior-order window,
            lookups (equi and substring), contexts, profiles, encoders,
            ranking/threshold metrics.
plans/      composed jobs: feature build from a spec, model fit/score,
            month backtest, importance and attribution.
streaming/  micro-batch scoring with ``foreachBatch``.
"""

from orderlens.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
