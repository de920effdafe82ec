"""Training-data operators (text corpora, web pages) on Spark."""
