"""tidemark: document-stream analytics on PySpark DataFrames."""
