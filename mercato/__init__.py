"""mercato: a Spark-native retail lakehouse.

Raw files land in bronze, are cleaned into a typed silver layer, and become a
gold star schema (facts, dimensions, sales marts). Dashboard analytics and
data-quality reports are lazy DataFrame queries over gold.
"""

__version__ = "0.1.0"
