"""panelmill: a PySpark-native engine for building figure-and-caption datasets."""
