"""Labour-market data lake on Spark: landing, standardisation, facts and market views."""
