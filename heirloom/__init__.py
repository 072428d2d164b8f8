"""heirloom: a PySpark-native engine for kinship claims, entity graphs and document corpora."""

__version__ = "0.1.0"
