"""docsift: document, receipt, evaluation and mail work as Spark DataFrame jobs."""

__version__ = "0.1.0"
