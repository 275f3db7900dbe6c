"""starflow: a layered market-data warehouse built on Spark DataFrames.

Layers: ingress (all text) → ods (typed, keyed) → staging (cleaned) →
transforms/marts (star schema), plus checks and a framed-message stream.
"""

__version__ = "0.1.0"
