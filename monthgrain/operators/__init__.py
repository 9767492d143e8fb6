"""Views, query families, seasonality, catalog, exports and facts."""
