"""Sources and sinks: delimited text, JDBC, and the fixture views."""

from tillroll.sources.delimited import (  # noqa: F401
    read_delimited,
    read_delimited_with_schema,
    read_table,
    replace_table,
    write_delimited,
    write_jdbc,
    write_partitioned_recommendations,
)
from tillroll.sources.fixtures import load_tables, raw_transactions, transactions  # noqa: F401
