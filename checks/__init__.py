"""Every operator as a query on the driver's tables, with the same query as DuckDB SQL."""
