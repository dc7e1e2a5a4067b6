"""Dashboard analytics as lazy DataFrame queries, one module per page."""
