"""Securities-disclosure and market-price tables maintained with PySpark."""
