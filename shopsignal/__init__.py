"""ShopSignal: e-commerce click logs -> market baskets, affinity profiles,
cart abandonment and a marketing campaign, as PySpark DataFrame jobs.

Every public job takes DataFrames (plus parameters) and returns a DataFrame.
No job creates a session, collects rows to the driver or uses a Python UDF.
"""

__version__ = "0.1.0"
