"""tessera: data-model metadata as Spark tables, and the model's rules as Spark jobs."""

__version__ = "0.1.0"
