"""headway: a PySpark-native engine for service-delay analytics."""
