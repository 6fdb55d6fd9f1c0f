"""stratum: layered (bronze -> silver -> gold) warehouse building blocks on Spark DataFrames.

Column functions live in :mod:`stratum.functions`, DataFrame operators in
:mod:`stratum.operators`, sources / seeds / sinks in :mod:`stratum.sources`,
the warehouse models and their runner in :mod:`stratum.plans`.
"""

__version__ = "0.1.0"

__all__ = ["__version__"]
