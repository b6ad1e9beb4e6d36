"""framequarry: a Spark-first engine that curates captioned frame datasets."""
