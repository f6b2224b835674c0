"""farelane: trip-record curation operators expressed as Spark DataFrame plans.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``); composed plans live in :mod:`farelane.plans`.
"""

__version__ = "0.1.0"
