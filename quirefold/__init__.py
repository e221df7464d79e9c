"""quirefold: document-ingestion analytics and text preparation on PySpark DataFrames."""

__version__ = "0.1.0"
