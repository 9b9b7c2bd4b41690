"""Training-data operators on Spark; nothing outside this folder and ``corpus_pipeline.py`` imports it."""
