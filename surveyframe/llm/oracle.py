"""DuckDB SQL for the queries that SQL can express; the others are tested against plain versions."""

ORACLE: dict[str, str] = {}
