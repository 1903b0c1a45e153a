"""staylens: review analytics as Spark DataFrame operators.

Operators take a DataFrame and column names and return a lazy DataFrame, so the
same code runs on a thousand reviews in local mode and on a cluster-sized table.
"""

__version__ = "0.1.0"
