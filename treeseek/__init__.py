"""treeseek: search and analytics over trees of versioned content, as Spark jobs."""

__version__ = "0.1.0"
