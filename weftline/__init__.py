"""weftline: document-relation and training-data operators on Spark DataFrames."""
