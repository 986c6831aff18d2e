"""ledgerlens: internal-audit checks over distributor ledgers, on Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame
operators), ``sources`` (views, contact sheets, sinks), ``plans`` (the audit
checks and the confirmation job), ``streaming`` (streaming confirmation).
"""

__version__ = "0.1.0"
