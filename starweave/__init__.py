"""Star-schema ETL and star queries as plain PySpark DataFrame operators."""
