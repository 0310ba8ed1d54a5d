"""silverlode: contract-first medallion pipelines as Spark DataFrame plans."""

__version__ = "0.1.0"
