"""cargolens: Spark-first analytics for shipment records and text corpora."""

__version__ = "0.1.0"
