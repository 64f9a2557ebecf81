"""Bronze, silver and gold feature and label tables for loan-default modelling, on Spark.

``functions`` holds Column -> Column expressions, ``operators`` DataFrame -> DataFrame building blocks,
``sources`` readers and writers, ``plans`` the layer-by-layer jobs, and ``catalog`` the registered queries.
"""
