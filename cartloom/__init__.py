"""cartloom: retail order analytics as Spark DataFrame plans.

Raw order, item, customer, product and payment tables become cleaned staging tables, a star
schema and seven marts, with data-quality rules and profiles for every layer.
"""

from cartloom.params import JobParams

__all__ = ["JobParams"]
