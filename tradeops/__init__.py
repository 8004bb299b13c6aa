"""tradeops: freight-operations and trade-finance reporting on Spark DataFrames.

``functions``  column expressions (text, dates, payload, business rules)
``operators``  DataFrame -> DataFrame building blocks that hold under key skew
``sources``    input tables, schemas and the result publisher
``plans``      the sixteen reports, composed from the above
``workload``   the registered queries over the test tables, with their SQL twins
"""
