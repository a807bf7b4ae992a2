"""A Spark-native bronze -> silver -> gold lakehouse for GeoJSON event feeds.

Every operator is a function from DataFrame to DataFrame built from native
expressions; actions happen only in the sinks (`sources`) and jobs (`plans`).
"""
