"""Long-document segmentation and quality analytics, expressed as Spark plans."""

__version__ = "0.1.0"
