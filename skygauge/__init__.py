"""Climate, air-quality and solar analytics on Spark DataFrames.

Layers: ``sources`` (files, tables, Kafka, JDBC), ``functions`` (column expressions),
``operators`` (DataFrame to DataFrame), ``plans`` (silver, gold and batch runs),
``streaming`` (sensor readings) and ``contract`` (queries with their check SQL).
"""
