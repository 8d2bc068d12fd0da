"""Spark-native enrichment, demand labelling and fairness analytics.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
with column names as arguments.  Nothing here collects rows to the driver; the
few values that do reach it are model parameters and size checks.
"""
