"""sparklab: data work as DataFrame -> DataFrame functions on Spark."""

__version__ = "0.1.0"
