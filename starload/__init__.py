"""starload: loading and summarising a retail star schema with Spark DataFrames.

Nested order documents and web-session records are validated and flattened, type-0 and type-2 dimensions
are maintained with scalable surrogate keys, facts are resolved against the dimensions and merged by key, and
a daily snapshot is derived, all as composable DataFrame -> DataFrame functions.
"""

__version__ = "0.1.0"
