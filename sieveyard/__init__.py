"""Sieveyard: a Spark-native engine that curates source code and text into training data."""
