"""syllaspark: a Spark-native engine for course-plan text analytics."""

__version__ = "0.1.0"
