"""A PySpark engine for document retrieval, document graphs and training-data pipelines."""
