"""Retail medallion pipeline as a Spark library.

Bronze feeds are typed on arrival, cleaned into Silver staging tables,
modelled into Gold dimensions and facts, and guarded by gates between the
layers.  Every operator takes DataFrames and returns a DataFrame; reading and
writing live in ``sources``, ``streaming`` and ``plans`` only.
"""
