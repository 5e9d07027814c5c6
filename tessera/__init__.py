"""tessera: wide-column (rowkey, family, qualifier, version) tables as Spark DataFrames.

A table is a Parquet *mutation log* (see :mod:`tessera.model`).  Every read
resolves the live latest version of each cell with a DataFrame plan, every
write appends a batch of mutations, and all filtering, shaping, joining and
nearest-neighbour work is expressed with DataFrame / SQL operators so that
Catalyst and AQE choose the physical strategy.
"""

from tessera.model import LOG_COLUMNS, LOG_SCHEMA, Catalog  # noqa: F401
from tessera.operators.versions import latest_cells  # noqa: F401

__all__ = ["LOG_COLUMNS", "LOG_SCHEMA", "Catalog", "latest_cells"]
