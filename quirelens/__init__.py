"""Page-feature analytics over digitised-book corpora, written on the Spark DataFrame API."""
