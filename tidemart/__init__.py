"""Spark-native commerce lakehouse: feeds -> quality gate -> clean layer -> star schema -> marts."""
