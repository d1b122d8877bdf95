"""A PySpark-native engine that ingests, cleans, deduplicates and maintains job postings."""
