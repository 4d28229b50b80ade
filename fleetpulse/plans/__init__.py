"""Query catalogue (name → Spark callable) and the matching DuckDB SQL."""
