"""Water-quality observation harmonisation on Spark DataFrames.

Public entry point: :func:`obsharmony.plans.assemble.assemble`.
"""

__version__ = "0.1.0"
