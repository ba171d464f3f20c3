"""Outage facts crossed with an hourly gridded covariate, on Spark DataFrames.

Tables and columns keep the names of the published data model (``interrupcoes``,
``dim_conjunto``, ``mart_mensal`` ...), so a query written against those tables
runs unchanged once the layers are registered (``sources.layers``).
"""
