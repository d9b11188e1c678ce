"""adsift: search-advertising data work (keyword matching, ad-log flattening,
app snapshots and training features) as Spark DataFrame operators."""

__version__ = "0.1.0"
