"""evolve: move a dataset of Spark tables from one schema version to the next."""

from evolve.dataset import Dataset

__all__ = ["Dataset"]
