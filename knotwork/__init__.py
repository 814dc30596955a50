"""Knowledge graphs and corpus pipelines as PySpark DataFrame transformations."""
