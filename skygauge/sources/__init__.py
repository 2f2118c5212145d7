"""Reading and writing: CSV files, keyed Parquet tables, Kafka and JDBC."""
