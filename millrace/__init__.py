"""millrace: document analytics and corpus preparation on PySpark DataFrames."""
