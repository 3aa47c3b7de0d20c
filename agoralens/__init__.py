"""Opinion mining on Spark: profile, clean, match, classify and conclude."""

__version__ = "0.1.0"
