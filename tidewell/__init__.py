"""Batch reporting operators for policy, agent, customer, claim and ledger data on Spark.

Layers, lowest first:

``functions``  column expressions (text, dates, amounts, conditions)
``sources``    reading, writing, views, SQL with parameters, report calendar
``operators``  joins, aggregates, windows, ranks and set operations on DataFrames
``plans``      the reports: DataFrames in, DataFrame out, run date as an argument
``queries``    the reports and operators over the driver's test tables, with oracle SQL
"""

__version__ = "0.1.0"
