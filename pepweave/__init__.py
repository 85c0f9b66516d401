"""PySpark-native engine for judging peptide-spectrum matches."""
