"""voltaic — layered (landing → silver → gold) analytics for hourly
generation and price series, written as lazy Spark DataFrame operators."""

__version__ = "0.1.0"
