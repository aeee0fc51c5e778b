"""quire: corpus preparation and evaluation for language-model data on Spark.

Every operator is a function from DataFrame(s) to a DataFrame. Row order is
always explicit (an order key), so results do not depend on partitioning.
"""

__all__ = ["session", "schemas"]
