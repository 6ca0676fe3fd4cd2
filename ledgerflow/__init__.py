"""ledgerflow: Spark-native transaction enrichment.

Batch build (stage -> customer profile -> enriched fact), CDC compaction,
a Structured Streaming stream-table join with a dead-letter output,
declarative data-quality checks, and a fit / sample / corrupt / audit job
for synthetic transactions.  Everything is expressed with DataFrames.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
