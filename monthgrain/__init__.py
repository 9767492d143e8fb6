"""Monthly-panel analytics on Spark: views, query families, seasonality, catalog, exports and facts."""
