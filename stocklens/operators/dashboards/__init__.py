"""Dashboard panels: each is a function of the mart, the chosen filters and the as-of date."""
