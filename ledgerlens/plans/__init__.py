"""Query catalogue: each registered query is an operator bound to the test
parameters (``catalog``), with an independent DuckDB SQL oracle over the
raw test tables (``oracle``)."""
