"""Trips, weather, positions and postcodes derived from the given test tables (see FIXTURES.md)."""
