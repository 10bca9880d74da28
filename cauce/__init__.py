"""cauce: channel-propensity analytics as lazy Spark DataFrame operators.

Transactions (one row per order) become one feature row per customer,
a leakage-aware label, temporal splits, encodings, distributed ranking
metrics, quantile segments and a boosted-tree model, all planned by
Catalyst and executed by Spark without collecting data to the driver
(only small fitted state: quantile edges, vocabularies, metric rows).
"""

from cauce.spec import Columns, FeatureSpec, ModelSpec, COLUMNS, FEATURES, MODEL

__all__ = ["Columns", "FeatureSpec", "ModelSpec", "COLUMNS", "FEATURES", "MODEL"]
