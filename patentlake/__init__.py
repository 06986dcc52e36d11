"""patentlake: PySpark-native analytics for bibliographic change feeds."""
