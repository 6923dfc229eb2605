"""Trip-record analytics on the Spark DataFrame API.

``functions``  Column -> Column building blocks
``operators``  DataFrame -> DataFrame transforms, lazy, column names as parameters
``sources``    reads and writes: parquet, JDBC, the dimensions, stored models
``plans``      the jobs made of them: ETL, report tables, training, life cycle
``bindings``   the registered queries over the test tables, and their SQL
"""
