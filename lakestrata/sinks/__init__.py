"""Writers: layer tables and relational serving tables."""
