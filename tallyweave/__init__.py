"""Spark-native procurement reconciliation, supply allocation and API ingestion."""
