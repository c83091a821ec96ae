"""Sources: input tables, the raw tables derived from them, landed pages and bronze."""

from tidemark.sources.landing import (add_lineage, filter_resource, list_resource, page_slice, page_totals,
                                      paginate, read_bronze, read_envelopes, to_raw, write_bronze, write_landing)
from tidemark.sources.tables import read_table

__all__ = ["add_lineage", "filter_resource", "list_resource", "page_slice", "page_totals", "paginate",
           "read_bronze", "read_envelopes", "read_table", "to_raw", "write_bronze", "write_landing"]
