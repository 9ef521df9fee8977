"""newsweft: a PySpark-native engine for measuring who is heard in the news."""
