"""tallyrec: a daily content recommender expressed as Spark DataFrame jobs.

Every operator is a function ``DataFrame(s) -> DataFrame``; dates, patterns,
group names and k-values are parameters.  Nothing is collected to the driver
except single scalars (the run date) and bounded model metrics.
"""

__version__ = "0.1.0"
