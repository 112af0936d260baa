"""The same questions in plain SQL, written independently of the Spark operators.

Only the raw shapes are shared with the Spark side; cleaning, joins and aggregates are stated anew.
"""

from patronlake.oracle.statements import oracle_statements

__all__ = ["oracle_statements"]
