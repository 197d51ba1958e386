"""Marketing, sales and CRM marts as lazy Spark DataFrame functions."""

__version__ = "0.1.0"
