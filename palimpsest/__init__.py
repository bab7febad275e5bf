"""A document-corpus cleaning engine on PySpark DataFrames."""
