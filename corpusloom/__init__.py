"""corpusloom: language-model corpus preparation as plain PySpark DataFrame jobs."""

__version__ = "0.1.0"
