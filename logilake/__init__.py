"""Spark-native logistics analytics: raw documents -> typed tables -> star schema -> delivery KPIs."""
