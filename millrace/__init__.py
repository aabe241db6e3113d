"""Spark-native pipelines: page views, trending posts, graph distance, aligned reads."""
