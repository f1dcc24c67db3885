"""cardlake: a PySpark-native medallion analytics engine for card transactions."""
