"""DataFrame operators: cleaning, conforming, star tables, loads, analytics, series, model, decisions."""
